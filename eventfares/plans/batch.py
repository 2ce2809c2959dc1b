"""The average of whole feed directories, as a batch job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventfares.operators import fares
from eventfares.operators.aggs import event_fare_avg
from eventfares.sources import feeds, parse

CONCERT_IDENTITY = ["artist", "event_date", "event_city"]


def average_fares(
    spark: SparkSession, concerts: str, flights: str, latest_only: bool = False
) -> DataFrame:
    """Average fare per city and date over everything in the two feeds.

    Snapshots repeat concerts and fares, and each repeat counts. With `latest_only` a concert counts
    once, and a fare at its most recent price.
    """
    listed = parse.accepted(parse.concerts(feeds.feed_lines(spark, concerts)))
    priced = parse.accepted(feeds.read_flights(spark, flights))
    if latest_only:
        listed = listed.dropDuplicates(CONCERT_IDENTITY)
        priced = fares.latest(priced, feeds.ARRIVAL)
    return event_fare_avg(listed, priced)
