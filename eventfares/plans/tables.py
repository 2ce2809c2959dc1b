"""The feeds' records seen in the given tables: orders as concerts, line items as fares.

An order is a concert by its customer, in the customer's nation, on the order date. A line item is a
fare from the customer's nation to the supplier's, on the ship date. Money is in whole cents, whose
sums are exact. Dimension joins carry no hint: the planner broadcasts a table or not by its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PAGE_EVENTS = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a stream of its files."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("long")


def _artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_name", F.col("n_name").alias("home_city"))
    )


def _destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.col("n_name").alias("end_city"))
    )


def concerts(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """concert_id, artist, event_date, event_city."""
    orders = orders if orders is not None else table(spark, sf_dir, "orders")
    return orders.join(_artists(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("concert_id"),
        F.col("c_name").alias("artist"),
        F.col("o_orderdate").cast("date").alias("event_date"),
        F.col("home_city").alias("event_city"),
    )


def arrivals(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """end_city, flight_date, cents: all that questions about a destination ask of a fare. And the
    line item columns in `also`."""
    lines = lines if lines is not None else table(spark, sf_dir, "lineitem")
    return lines.join(_destinations(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey")).select(
        "end_city",
        F.col("l_shipdate").cast("date").alias("flight_date"),
        cents(F.col("l_extendedprice")).alias("cents"),
        *also,
    )


def flights(spark: SparkSession, sf_dir: str, *also: str) -> DataFrame:
    """start_city, end_city, flight_date, price, cents, and the line item columns in `also`."""
    customers, orders = _artists(spark, sf_dir), table(spark, sf_dir, "orders")
    origins = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.col("home_city").alias("start_city")
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(_destinations(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(origins, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            "start_city",
            "end_city",
            F.col("l_shipdate").cast("date").alias("flight_date"),
            F.col("l_extendedprice").alias("price"),
            cents(F.col("l_extendedprice")).alias("cents"),
            *also,
        )
    )


def amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, user_id, event_type, cents: a keyed sequence of amounts in order of event_id."""
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", cents(F.col("value")).alias("cents")
    )


def event_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages built from the orders, as JSON text, up to `PAGE_EVENTS` events each."""
    items = _events(spark, sf_dir).select(F.to_json("event").alias("body"))
    return items.mapInPandas(_bind, "body string")


def paged_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`city, page, body`: the listing of each city's events in pages that say their numbers."""
    orders = table(spark, sf_dir, "orders").join(_artists(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
    numbered = orders.select(
        F.col("home_city").alias("city"),
        "o_orderkey",
        (F.row_number().over(Window.partitionBy("home_city").orderBy("o_orderkey")) - 1).alias("place"),
        F.count("*").over(Window.partitionBy("home_city")).alias("total"),
    )
    pages = numbered.groupBy("city", "total", F.expr(f"place div {PAGE_EVENTS} + 1").alias("page")).agg(
        F.collect_list(F.struct(F.col("o_orderkey").alias("id"))).alias("event")
    )
    numbers = F.struct(
        "page", F.lit(PAGE_EVENTS).alias("perPage"), F.col("total").alias("totalEntries"), F.struct("event").alias("results")
    )
    return pages.select("city", "page", F.to_json(F.struct(numbers.alias("resultsPage"))).alias("body"))


def _bind(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Consecutive events of a task onto pages, by putting their JSON side by side."""
    for batch in batches:
        pages = [
            ",".join(batch["body"].iloc[first : first + PAGE_EVENTS])
            for first in range(0, len(batch), PAGE_EVENTS)
        ]
        bodies = [f'{{"resultsPage":{{"results":{{"event":[{events}]}}}}}}' for events in pages]
        yield pd.DataFrame({"body": bodies}, dtype="object")


def setlist_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Setlist pages built from conversations, with the event each belongs to.

    A conversation is an event, a turn a setlist, a sentence a song, the last one the encore.
    """
    songs = F.split("text", r"\. ")
    items = F.transform(
        songs,
        lambda s, i: F.struct(
            s.alias("name"), F.when(i == F.size(songs) - 1, 1).otherwise(0).alias("encore")
        ),
    )
    setlist = F.struct(
        F.col("turn").alias("id"),
        F.concat_ws(" ", F.lit("Set"), F.col("turn")).alias("displayName"),
        F.struct(F.col("role").alias("displayName")).alias("artist"),
        items.alias("setlistItem"),
    )
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("event_id"),
        F.to_json(_page(F.struct(F.array(setlist).alias("setlist")))).alias("body"),
    )


def _page(results: Column) -> Column:
    return F.struct(F.struct(results.alias("results")).alias("resultsPage"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One `event` struct per order. Held ('O') orders have no start time; 'P' ones are off."""
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    timed = F.col("o_orderstatus") != "O"
    identifiers = F.array(
        F.struct(F.md5(F.col("c_custkey").cast("string")).alias("mbid")),
        F.struct(F.md5("c_mktsegment").alias("mbid")),
    )
    headline = F.struct(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("displayName"),
        F.lit("headline").alias("billing"),
        F.lit(1).alias("billingIndex"),
        F.struct(F.col("c_name").alias("displayName"), identifiers.alias("identifier")).alias(
            "artist"
        ),
    )
    support_name = F.concat(F.lit("Band of "), F.col("n_name"))
    support = F.struct(
        (-1 - F.col("n_nationkey").cast("long")).alias("id"),
        support_name.alias("displayName"),
        F.lit("support").alias("billing"),
        F.lit(2).alias("billingIndex"),
        F.struct(
            support_name.alias("displayName"),
            F.array(F.struct(F.md5("n_name").alias("mbid"))).alias("identifier"),
        ).alias("artist"),
    )
    event = F.struct(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "P", "cancelled").otherwise("ok").alias("status"),
        F.lit("concert").alias("type"),
        F.concat_ws(" at ", "c_name", "n_name").alias("displayName"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("popularity"),
        F.struct(F.col("o_orderpriority").alias("displayName")).alias("series"),
        F.struct(
            F.col("n_nationkey").alias("id"),
            F.concat_ws(" ", "n_name", F.lit("Hall")).alias("displayName"),
            F.struct(
                F.col("n_nationkey").alias("id"),
                F.col("n_name").alias("displayName"),
                F.struct(F.col("r_name").alias("displayName")).alias("country"),
            ).alias("metroArea"),
        ).alias("venue"),
        F.struct(F.concat_ws(", ", "n_name", "r_name").alias("city")).alias("location"),
        F.struct(
            day.alias("date"),
            F.when(timed, F.lit("20:00:00")).alias("time"),
            F.when(timed, F.concat(day, F.lit("T20:00:00+0100"))).alias("datetime"),
        ).alias("start"),
        F.array(headline, support).alias("performance"),
    )
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(event.alias("event"))
    )
