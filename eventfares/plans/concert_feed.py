"""The concert feed: listing pages in, a CSV snapshot of numbered concerts out."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventfares.operators.events import in_cities, search, to_concerts
from eventfares.operators.ordering import number_rows
from eventfares.settings import EVENT_CITIES, SEARCH_FROM, SEARCH_TO
from eventfares.sources.sinks import concert_snapshot, write_feed


def concerts_from(
    events: DataFrame,
    artists: list[str] | DataFrame,
    cities: list[str] | DataFrame = EVENT_CITIES,
    first: date | str = SEARCH_FROM,
    last: date | str = SEARCH_TO,
) -> DataFrame:
    """Concerts of the listed artists in the listed cities, numbered by list entry, then date."""
    # By city first: the search makes a row of every performer.
    found = search(in_cities(events, cities, F.col("location.city")), artists, first, last)
    rows = to_concerts(found, "list_position", "id")
    return concert_snapshot(number_rows(rows, "list_position", "event_date", "id"))


def publish(concerts: DataFrame, feed: str, moment: datetime) -> str:
    return write_feed(concerts, feed, moment)
