"""Readers of listing pages: JSON responses that wrap a list of events or setlists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventfares.functions.scalars import once
from eventfares.schemas import CORRUPT, EVENT, SETLIST, page

EVENT_LIST = "event"
SETLIST_LIST = "setlist"


def page_bodies(spark: SparkSession, path: str, whole_files: bool = False, request: str | None = None) -> DataFrame:
    """Page bodies below `path`: one per line, or one per file. Partition columns are kept.

    With `request`, columns that say what a page was asked for, a line is a JSON record of them and
    of the `body`, so that pages of many requests share a file. A line that is no such record is a
    body itself, whose request is not known.
    """
    bodies = spark.read.text(path, wholetext=whole_files).withColumnRenamed("value", "body")
    if request is None:
        return bodies
    others = [c for c in bodies.columns if c != "body"]
    records = bodies.select("*", once(F.from_json("body", f"{request}, body string")).alias("_record"))
    asked = [F.col(f"_record.{field.name}") for field in T.StructType.fromDDL(request)]
    return records.select(*others, *asked, F.coalesce("_record.body", "body").alias("body"))


def read_event_pages(
    spark: SparkSession, path: str, whole_files: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Events, one row each, and with the reason the pages that hold no list, and unfit events."""
    return event_pages(page_bodies(spark, path, whole_files))


def read_setlist_pages(
    spark: SparkSession, path: str, whole_files: bool = False, request: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Setlists, one row each, and rejected pages and setlists.

    The event a page was asked for is not in its body, so it is a partition, `path/event_id=...`, or
    with a `request` of `event_id bigint` stands beside the body in its record (see `page_bodies`).
    Folders are for a few events: their number grows with the events, that of files of records does not.
    """
    return setlist_pages(page_bodies(spark, path, whole_files, request))


def event_pages(bodies: DataFrame) -> tuple[DataFrame, DataFrame]:
    return _decode(bodies, EVENT_LIST, EVENT)


def setlist_pages(bodies: DataFrame) -> tuple[DataFrame, DataFrame]:
    return _decode(bodies, SETLIST_LIST, SETLIST)


def setlist_items(setlists: DataFrame) -> DataFrame:
    """One row per song: its title, place in the set, and whether it was an encore."""
    kept = [c for c in setlists.columns if c != "setlistItem"]
    return setlists.select(*kept, F.posexplode("setlistItem").alias("position", "_item")).select(
        *kept,
        "position",
        F.col("_item.name").alias("title"),
        (F.col("_item.encore") != 0).alias("encore"),
    )


def page_numbers(bodies: DataFrame) -> DataFrame:
    """The columns of `bodies` but the body, with the `page`, `per_page` and `total` that it says.

    Numbers that are missing or no whole numbers are null.
    """
    others = [c for c in bodies.columns if c != "body"]
    said = {"page": "page", "per_page": "perPage", "total": "totalEntries"}
    return bodies.select(*others, *[F.get_json_object("body", f"$.resultsPage.{field}").try_cast("bigint").alias(name) for name, field in said.items()])


def missing_pages(numbers: DataFrame, *request: str) -> DataFrame:
    """The pages of each request that did not come: `request..., first_page, last_page, n_entries`, a
    row for every range of them.

    `numbers` are the `page_numbers` of the pages that came. A request has as many pages as its
    greatest total takes at its greatest number of entries a page; a page that came twice counts
    once. Of a request without any page, or with none that says these numbers, nothing is known.
    """
    known = numbers.where("page > 0 and per_page > 0 and total >= 0")
    pages = known.groupBy(*request, "page").agg(F.max("per_page").alias("per_page"), F.max("total").alias("total"))
    sizes = pages.groupBy(*request).agg(F.max("per_page").alias("per_page"), F.max("total").alias("total"))
    sizes = sizes.withColumn("n_pages", F.ceil(F.col("total") / F.col("per_page")).cast("bigint"))
    # A page before the first and one after the last, so that all that is missing lies between two.
    ends = sizes.select(*request, F.explode(F.array(F.lit(0).cast("bigint"), F.col("n_pages") + 1)).alias("page"))
    places = pages.select(*request, "page").unionByName(ends)
    after = F.lead("page").over(Window.partitionBy(*request).orderBy("page"))
    gaps = places.withColumn("_after", after).where(F.col("_after") > F.col("page") + 1)
    size = sizes.select(*[F.col(c).alias(f"_{c}") for c in request], "per_page", "total", "n_pages")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in request]
    found = gaps.join(size, same).select(
        *request, (F.col("page") + 1).alias("first_page"), (F.col("_after") - 1).alias("last_page"), "per_page", "total", "n_pages"
    )
    entries = F.least(F.col("last_page") * F.col("per_page"), "total") - (F.col("first_page") - 1) * F.col("per_page")
    return found.where("first_page <= n_pages").select(*request, "first_page", "last_page", entries.alias("n_entries"))


def _decode(bodies: DataFrame, enclosure: str, item: str) -> tuple[DataFrame, DataFrame]:
    """Items, and what is set aside with its reason: whole pages, and items that do not fit."""
    others = [c for c in bodies.columns if c != "body"]
    # The items stay text at first, so that one of another shape does not spoil its page.
    schema = f"{page(enclosure, 'string')}, {CORRUPT} string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    pages = bodies.select("*", once(F.from_json("body", schema, options)).alias("_page"))
    items, reason = F.col(f"_page.resultsPage.results.{enclosure}"), _reason(enclosure)
    bad = pages.where(reason.isNotNull()).select(*others, "body", reason.alias("reason"))

    texts = pages.select(*others, F.explode(F.when(reason.isNull(), items)).alias("body"))
    wanted = T.StructType.fromDDL(f"_item {item}").fields[0].dataType.add(CORRUPT, "string")
    read = texts.select("*", once(F.from_json("body", wanted, options)).alias("_item"))
    unfit = F.col("_item").isNull() | F.col(f"_item.{CORRUPT}").isNotNull()
    good = read.where(~unfit).select(*others, "_item.*").drop(CORRUPT)
    set_aside = read.where(unfit).select(*others, "body", F.lit(f"bad {enclosure}").alias("reason"))
    return good, bad.unionByName(set_aside)


def _reason(enclosure: str) -> Column:
    undecoded = F.col("_page").isNull() | F.col(f"_page.{CORRUPT}").isNotNull()
    missing = F.col(f"_page.resultsPage.results.{enclosure}").isNull()
    return F.when(undecoded, F.lit("malformed")).when(missing, F.lit(f"no {enclosure} list"))
