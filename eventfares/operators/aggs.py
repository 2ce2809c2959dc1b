"""Average fare per city and concert date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventfares.functions.scalars import days_after
from eventfares.settings import DAYS_BEFORE


def event_fare_avg(
    concerts: DataFrame,
    flights: DataFrame,
    price: str = "price",
    unit: float = 1.0,
    days: int = DAYS_BEFORE,
) -> DataFrame:
    """Mean fare, and number of (concert, fare) matches, per (event_city, event_date).

    A fare counts once for each concert of that city and date. Rather than join and then average,
    fares are summed per (city, day) and carried forward to the `days` dates they serve, concerts
    are counted per (city, date), and the two meet with one row per key on either side. Every
    shuffle follows a map-side combine, so what moves is bounded by cities times dates and a hot
    city costs no more than any other.

    `unit` divides the mean: pass 100.0 with prices in cents, whose sums are exact.
    """
    daily = flights.groupBy("end_city", "flight_date").agg(
        F.sum(price).alias("_total"), F.count(price).alias("_fares")
    )
    served = (
        daily.select(
            F.col("end_city").alias("event_city"),
            F.explode(days_after(F.col("flight_date"), days)).alias("event_date"),
            "_total",
            "_fares",
        )
        .groupBy("event_city", "event_date")
        .agg(F.sum("_total").alias("_total"), F.sum("_fares").alias("_fares"))
    )
    held = concerts.groupBy("event_city", "event_date").agg(F.count("*").alias("_concerts"))
    return (
        held.join(served, ["event_city", "event_date"])
        .where("_fares > 0")
        .select(
            "event_city",
            "event_date",
            (F.col("_total").cast("double") / F.col("_fares") / F.lit(unit)).alias("avg_price"),
            (F.col("_fares") * F.col("_concerts")).alias("n"),
        )
    )
