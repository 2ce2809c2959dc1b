"""Stage one of the live job: meet concerts and fares that arrive in the same interval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from eventfares.functions.scalars import days_before
from eventfares.settings import ARRIVAL_DELAY, BATCH_INTERVAL, DAYS_BEFORE
from eventfares.sources.feeds import ARRIVAL
from eventfares.streaming.combine import combine, combine_lists
from eventfares.streaming.hot import Salts


def join_feeds(
    concerts: DataFrame,
    flights: DataFrame,
    interval: str = BATCH_INTERVAL,
    delay: str = ARRIVAL_DELAY,
    days: int = DAYS_BEFORE,
    salts: int | Salts = 1,
) -> DataFrame:
    """Fares with the concert dates they serve, where fare and concerts arrived in one `interval`.

    Each row has the fare's columns, `event_city` and `event_date`, and its `weight`: concerts on
    that date times copies of the fare. So there are at most `days` rows per fare and batch of
    concerts, and never one per pair.

    The range of dates and the shared interval are equalities here, so the join keeps its state per
    (interval, city, date); it keeps fares in lists, as a row of state for each would not fit in
    memory. A row leaves the state once arrivals are `delay` past its interval;
    until then it meets every later partner, so `delay` must cover how far arrivals are out of order.
    What comes later still is dropped and counted (see `run.late_rows`).

    A state key belongs to one task, so a hot one is dealt out over `salts` tasks: each fare to one
    of them by its content, and the concerts' count to all. `hot.decided` gives each city a number of
    its own; a number for all cities copies the concerts of those that need none.
    """
    if isinstance(salts, int):
        n_salts = lambda city, start: F.lit(salts).cast("long")
    else:
        n_salts = lambda city, start: salts(city, start).cast("long")
    held = combine(concerts, interval, ["event_city", "event_date"])
    columns = [c for c in flights.columns if c != ARRIVAL]
    salt = F.pmod(F.xxhash64(*columns), n_salts(F.col("end_city"), F.col(ARRIVAL)))
    fares = combine_lists(flights, interval, columns, ["end_city", "flight_date"], salt)
    wanted = (
        _in_interval(held, interval, delay)
        .withColumnRenamed("n", "_concerts")
        .withColumn("flight_date", F.explode(days_before(F.col("event_date"), days)))
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), n_salts(F.col("event_city"), F.col("interval.start")) - 1)))
    )
    served = _in_interval(fares, interval, delay).withColumnRenamed("end_city", "event_city")
    matches = wanted.join(served, ["interval", "event_city", "flight_date", "_salt"])
    fare = matches.select("interval", "event_city", "flight_date", "event_date", "_concerts", F.explode("rows").alias("_fare"))
    others = [F.col("_fare")[c].alias(c) for c in columns if c not in ("end_city", "flight_date")]
    weight = F.col("_concerts") * F.col("_fare.n")
    return fare.select("interval", "event_city", "flight_date", "event_date", *others, weight.alias("weight"))


def join_totals(
    concerts: DataFrame,
    flights: DataFrame,
    price: str = "price",
    interval: str = BATCH_INTERVAL,
    delay: str = ARRIVAL_DELAY,
    days: int = DAYS_BEFORE,
) -> DataFrame:
    """The matches of `join_feeds` in sums: event_city, event_date, `total` of prices, and `n`.

    The fares of a (city, date) are added up first, and the concerts of one counted, so the join has
    one row per key, batch and side. Totals of several rows with one key are to be added up. Whole
    numbers are multiplied as decimals, which they cannot outgrow.
    """
    held = combine(concerts, interval, ["event_city", "event_date"])
    fares = combine(flights, interval, ["end_city", "flight_date"], price)
    wanted = (
        _in_interval(held, interval, delay)
        .withColumnRenamed("n", "_concerts")
        .withColumn("flight_date", F.explode(days_before(F.col("event_date"), days)))
    )
    served = _in_interval(fares, interval, delay).withColumnRenamed("end_city", "event_city")
    whole = isinstance(fares.schema["total"].dataType, T.IntegralType)
    total = F.col("total").cast("decimal(19,0)") if whole else F.col("total")
    concerts_held = F.col("_concerts").cast("decimal(18,0)") if whole else F.col("_concerts")
    return wanted.join(served, ["interval", "event_city", "flight_date"]).select(
        "event_city",
        "event_date",
        (total * concerts_held).alias("total"),
        (F.col("n") * F.col("_concerts")).alias("n"),
    )


def write_matches(matches: DataFrame, path: str) -> DataStreamWriter:
    """Append matches to Parquet. The sink's own log makes a replayed batch count once."""
    return matches.writeStream.outputMode("append").format("parquet").option("path", path)


def _in_interval(feed: DataFrame, interval: str, delay: str) -> DataFrame:
    # Only one event-time column may stay, so the arrival gives way to its interval.
    return (
        feed.withWatermark(ARRIVAL, delay)
        .withColumn("interval", F.window(ARRIVAL, interval))
        .drop(ARRIVAL)
    )
