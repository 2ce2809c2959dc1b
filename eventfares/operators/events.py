"""Searching, flattening and projecting events and setlists."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventfares.functions.convert import Field, columns, failures, to_date
from eventfares.functions.scalars import city_name

# The columns of events and setlists, and the page fields they come from.
_IDENTIFIER = (Field("data_uri", path="href"), Field("musicbrainz_id", path="mbid"))
_ARTIST = (
    Field("id"),
    Field("display_name", path="displayName"),
    Field("uri", path="artist__uri"),
    Field("identifiers", "list", path="artist__identifier", model=_IDENTIFIER),
    Field("billing"),
    Field("billing_index", path="billingIndex"),
)
_MOMENT = (Field("date", "date"), Field("time", "time"), Field("datetime", "datetime"))
_PLACE = (Field("city"), Field("latitude", path="lat"), Field("longitude", path="lng"))
_METRO_AREA = (
    Field("id"),
    Field("display_name", path="displayName"),
    Field("country", path="country__displayName"),
)
_VENUE = (
    Field("id"),
    Field("display_name", path="displayName"),
    Field("latitude", path="lat"),
    Field("longitude", path="lng"),
    Field("metro_area", "object", path="metroArea", model=_METRO_AREA),
    Field("uri"),
)

EVENT_MODEL = (
    Field("id"),
    Field("status"),
    Field("event_type", path="type"),
    Field("series", "object", model=(Field("display_name", path="displayName"),)),
    Field("venue", "object", model=_VENUE),
    Field("location", "object", model=_PLACE),
    Field("artists", "list", path="performance", model=_ARTIST),
    Field("display_name", path="displayName"),
    Field("popularity", "decimal"),
    Field("event_start", "object", path="start", model=_MOMENT),
    Field("event_end", "object", path="end", model=_MOMENT),
    Field("uri"),
)

SETLIST_MODEL = (
    Field("id"),
    Field("display_name", path="displayName"),
    Field(
        "artist",
        "object",
        model=(
            Field("id"),
            Field("display_name", path="displayName"),
            Field("uri"),
            Field("identifiers", "list", model=_IDENTIFIER),
        ),
    ),
    Field(
        "setlist_items",
        "list",
        path="setlistItem",
        model=(Field("title", path="name"), Field("encore", "boolean")),
    ),
)

ACTIVE = "ok"


def flatten(
    records: DataFrame, model: tuple[Field, ...], *also: str, failed: str | None = None
) -> DataFrame:
    """The model's columns, typed and completed, with the columns in `also` carried along.

    `failed` names one more column: the fields that had a value which did not convert, and are null.
    """
    marks = [failures(model).alias(failed)] if failed else []
    return records.select(*also, *columns(model), *marks)


def search(
    events: DataFrame, artists: list[str] | DataFrame, first: date | str, last: date | str
) -> DataFrame:
    """Events from `first` to `last` at which an artist of the list performs.

    Adds `list_position`. As with one request per list entry, an event appears once for every entry
    it matches, so a name listed twice returns its events twice. `artists` is a list, or a table
    `(list_position, artist)`.
    """
    if not isinstance(artists, DataFrame):
        names = F.array(*[F.lit(a) for a in artists])
        artists = events.sparkSession.range(1).select(
            F.posexplode(names).alias("list_position", "artist")
        )
    performers = F.array_distinct(F.transform("performance", lambda p: p["artist"]["displayName"]))
    return (
        events.where(to_date(F.col("start.date")).between(F.lit(first), F.lit(last)))
        .withColumn("artist", F.explode(performers))
        .join(artists, "artist")
        .drop("artist")
    )


def in_cities(events: DataFrame, cities: list[str] | DataFrame, city: Column) -> DataFrame:
    """Events whose `city` is in the list, or in the `city` column of a table."""
    if not isinstance(cities, DataFrame):
        return events.where(city.isin(list(cities)))
    return events.join(
        cities.select(F.col("city").alias("_allowed")), city == F.col("_allowed"), "left_semi"
    )


def _any_performer(test) -> Column:
    return F.coalesce(F.exists("performance", test), F.lit(False))


def by_mbid(events: DataFrame, mbid: str) -> DataFrame:
    """Events with a performer who has this MusicBrainz id among their identifiers."""
    return events.where(
        _any_performer(lambda p: F.exists(p["artist"]["identifier"], lambda i: i["mbid"] == mbid))
    )


def gigography(events: DataFrame, artist_id: int, as_of: date | str) -> DataFrame:
    """Past events of a performer: those that started before `as_of`."""
    return events.where(_past(as_of) & _any_performer(lambda p: p["id"] == artist_id))


def gigography_by_mbid(events: DataFrame, mbid: str, as_of: date | str) -> DataFrame:
    """`gigography` of the performer with this MusicBrainz id."""
    return by_mbid(events.where(_past(as_of)), mbid)


def _past(as_of: date | str) -> Column:
    return to_date(F.col("start.date")) < F.lit(as_of).cast("date")


def active(events: DataFrame) -> DataFrame:
    """Events that have not been called off."""
    return events.where(F.coalesce(F.col("status") == ACTIVE, F.lit(False)))


def setlists_for(setlists: DataFrame, event_id: int) -> DataFrame:
    """Setlists of one event. With `event_id` a partition, only its files are read."""
    return setlists.where(F.col("event_id") == event_id)


def first_setlist(setlists: DataFrame, event_id: int) -> DataFrame:
    """The event's setlist with the lowest id, or no row. One without an id comes last."""
    return setlists_for(setlists, event_id).orderBy(F.col("id").asc_nulls_last()).limit(1)


def first_setlists(setlists: DataFrame) -> DataFrame:
    """`first_setlist` of every event at once. Of setlists with one id, any."""
    record = F.struct(*[c for c in setlists.columns if c != "event_id"])
    return (
        setlists.groupBy("event_id")
        .agg(F.min_by(record, F.struct(F.col("id").isNull(), "id")).alias("_first"))
        .select("event_id", "_first.*")
    )


def to_concerts(events: DataFrame, *also: str) -> DataFrame:
    """Events as concert rows: first performer, start date, city name; `also` is carried along."""
    first_performer = F.get("performance", F.lit(0))
    return events.select(
        first_performer["artist"]["displayName"].alias("artist"),
        to_date(F.col("start.date")).alias("event_date"),
        city_name(F.col("location.city")).alias("event_city"),
        *also,
    )
