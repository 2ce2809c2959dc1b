"""Stage two of the live job: running averages kept in the state store."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

KEY = ["event_city", "event_date"]
AVERAGES = "event_city string, event_date date, avg_price double, n bigint"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def running_avg(totals: DataFrame, unit: float = 1.0) -> DataFrame:
    """Average and count per city and date; in update mode each batch emits the keys it changed.

    Takes rows of `total` and `n`. They are added up before they are shuffled, and state is one row
    per key, kept for good.
    """
    return (
        totals.groupBy(*KEY)
        .agg(F.sum("total").alias("_total"), F.sum("n").alias("n"))
        .select(*KEY, (F.col("_total").cast("double") / F.col("n") / unit).alias("avg_price"), "n")
    )


def running_avg_per_record(matches: DataFrame, unit: float = 1.0) -> DataFrame:
    """The average after every single record: one row out for each row of a `price` in.

    A row with a `weight` counts so many times at once. State is grouped by city and week, so that
    one call serves a week's dates instead of paying its fixed cost for each. Start the query inside
    `rocksdb_state`.
    """
    weight = F.col("weight") if "weight" in matches.columns else F.lit(1)
    weekly = matches.select(
        *KEY, "price", weight.cast("bigint").alias("weight"), F.trunc("event_date", "week").alias("week")
    )
    return weekly.groupBy("event_city", "week").transformWithStateInPandas(
        statefulProcessor=_RunningMeans(unit),
        outputStructType=AVERAGES,
        outputMode="Append",
        timeMode="None",
    )


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started within keep their state in RocksDB, as per-record state requires."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


class _RunningMeans(StatefulProcessor):
    """Keeps the sum and count of each date of one city and week: 7 dates at the most.

    Rows come in Arrow batches, and are never all held.
    """

    def __init__(self, unit: float) -> None:
        self._unit = unit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getValueState(
            "seen", "dates array<date>, totals array<double>, counts array<bigint>"
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        dates, totals, counts = self._seen.get() or ([], [], [])
        total, n = dict(zip(dates, totals)), dict(zip(dates, counts))
        for batch in rows:
            day = batch["event_date"]
            prices = (batch["price"].astype("float64") * batch["weight"]).groupby(day)
            sums = day.map(total).fillna(0.0).astype("float64") + prices.cumsum()
            seen = day.map(n).fillna(0).astype("int64") + batch["weight"].groupby(day).cumsum()
            last = ~day.duplicated(keep="last")
            total.update(zip(day[last], sums[last].tolist()))
            n.update(zip(day[last], seen[last].tolist()))
            yield pd.DataFrame(
                {
                    "event_city": key[0],
                    "event_date": day,
                    "avg_price": sums / seen / self._unit,
                    "n": seen,
                }
            )
        self._seen.update((list(total), list(total.values()), list(n.values())))

    def close(self) -> None:
        pass
