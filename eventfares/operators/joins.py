"""Joins of concerts with the fares that lead to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventfares.functions.scalars import days_before
from eventfares.settings import DAYS_BEFORE


def city_totals(concerts: DataFrame, flights: DataFrame, price: str = "price") -> DataFrame:
    """Concerts and the fares to their city, whatever the dates, in figures per city.

    Every concert of a city meets every fare to it, and the pairs themselves are of no use before
    their dates are compared (see `event_flights_window`). So both sides are reduced to one row per
    city before they meet: the number of pairs is the product, the mean fare that of the fares.
    """
    per_city = concerts.groupBy("event_city").agg(F.count("*").alias("n_concerts"))
    fares = flights.groupBy(F.col("end_city").alias("event_city")).agg(
        F.count(price).alias("n_flights"), F.sum(price).alias("total")
    )
    # The product is taken in floating point: at scale it outgrows a long.
    return per_city.join(fares, "event_city").select(
        "event_city",
        "n_concerts",
        "n_flights",
        (F.col("n_concerts").cast("double") * F.col("n_flights")).alias("pairs"),
        (F.col("total").cast("double") / F.col("n_flights")).alias("avg_price"),
    )


def fares_by_event_date(
    concerts: DataFrame, flights: DataFrame, days: int = DAYS_BEFORE
) -> DataFrame:
    """Each fare once for every concert date it serves in its city, with `n_concerts` on that date.

    The number of concerts stands for the pairs with each, so there are at most `days` rows per fare,
    however many concerts there are. Concerts are counted before they meet any fare.
    """
    held = concerts.groupBy("event_city", "event_date").agg(F.count("*").alias("n_concerts"))
    wanted = held.withColumn("flight_date", F.explode(days_before(F.col("event_date"), days)))
    return wanted.join(flights.withColumnRenamed("end_city", "event_city"), ["event_city", "flight_date"])


def event_flights_window(
    concerts: DataFrame, flights: DataFrame, days: int = DAYS_BEFORE
) -> DataFrame:
    """Each concert with the fares to its city that arrive 1 to `days` days before it.

    There is a row for every pair, so this is for the concerts of a list; `fares_by_event_date` says
    the same of all concerts in at most `days` rows per fare.

    A concert becomes one row per admissible flight date, which turns the date range into a second
    equality: the join hashes on (city, date) and never forms a pair it would have to drop. A hot
    (city, date) is left to the adaptive skew join, which splits both sides by map output and so
    also spreads exact copies of one row.
    """
    wanted = concerts.withColumn("flight_date", F.explode(days_before(F.col("event_date"), days)))
    fares = flights.withColumnRenamed("end_city", "event_city")
    return wanted.join(fares, ["event_city", "flight_date"])
