"""Averages of the latest fares, live: a fare that changes takes its old price back.

State are three tables beside the checkpoint, each of parts that a batch adds and that are merged now
and then: the latest fare of each cell, the sums of latest fares by city and day, and the concerts.
A batch finds the cells whose latest fare it changes and adds the differences, minus the old price and
plus the new one, to the sums. Only cells, days and dates that a batch touches are worked on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from eventfares.functions.scalars import days_after, days_before
from eventfares.operators.fares import CELL
from eventfares.settings import DAYS_BEFORE, new_path, remove
from eventfares.sources.feeds import ARRIVAL
from eventfares.streaming.parts import MERGE_EVERY, Parts

CONCERT = ["artist", "event_date", "event_city"]
DAY = ["end_city", "flight_date"]

def tables(spark: SparkSession, state: str, price: str) -> tuple[Parts, Parts, Parts]:
    """The latest fares, their sums by city and day, and the concerts, of a state whose prices have
    the type `price`."""
    total = "decimal(38,0)" if price in ("int", "bigint") else "double"
    cells = "start_city string, end_city string, flight_date date"
    last = F.max(F.struct("at", "price"))
    return (
        Parts(spark, f"{state}/cells", f"{cells}, at timestamp, price {price}", CELL, at=last["at"], price=last["price"]),
        Parts(spark, f"{state}/sums", f"end_city string, flight_date date, total {total}, n bigint", DAY, total=F.sum("total").cast(total), n=F.sum("n")),
        Parts(spark, f"{state}/concerts", "artist string, event_date date, event_city string", CONCERT),
    )


def feeds_as_one(concerts: DataFrame, flights: DataFrame) -> DataFrame:
    """Both feeds in one stream: a row has the fields of a concert or of a fare."""
    listed = concerts.select(F.struct(*CONCERT).alias("concert"))
    priced = flights.select(F.struct(*CELL, F.col("price"), F.col(ARRIVAL).alias("at")).alias("fare"))
    return listed.unionByName(priced, allowMissingColumns=True)


def write_latest_averages(
    both: DataFrame,
    state: str,
    send: Callable[[DataFrame, int], None],
    unit: float = 1.0,
    days: int = DAYS_BEFORE,
    merge_every: int = MERGE_EVERY,
) -> DataStreamWriter:
    """Send the averages that each batch of `feeds_as_one` changes: `event_city, event_date,
    avg_price, n`, as `plans.batch.average_fares` has them with `latest_only`.

    A concert counts once however often it is listed, and a cell's fare at the price that arrived
    last; of prices that arrived together, the highest. What arrives out of order counts by its
    arrival. `state` is a folder of the query's own, in which a batch that is replayed replaces what
    it left; `send(averages, batch_id)` has to do the same.
    """
    state = state.rstrip("/")
    price = both.schema["fare"].dataType["price"].dataType.simpleString()

    def update(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        merge = batch_id % merge_every == merge_every - 1
        cells, sums, concerts = tables(spark, state, price)
        # Written once: both feeds are read from it, and a change is worked out from what it was.
        path = new_path(spark, "latest-batch")
        batch.write.parquet(path)
        rows = spark.read.schema(batch.schema).parquet(path)

        changed = _changed(cells.one(rows.where("fare is not null").select("fare.*")), cells.before(batch_id))
        changed_path = new_path(spark, "latest-changed")
        changed.write.parquet(changed_path)
        changed = spark.read.schema(changed.schema).parquet(changed_path)
        differences = changed.groupBy(*DAY).agg(F.sum("d_total").alias("total"), F.sum("d_n").alias("n")).where("total <> 0 or n <> 0")
        listed = _unlisted(concerts.one(rows.where("concert is not null").select("concert.*")), concerts.before(batch_id))
        moved = sums.add(differences, batch_id, merge)
        new = concerts.add(listed, batch_id, merge)
        cells.add(changed.select(*CELL, "at", "price"), batch_id, merge)

        asked = new.select("event_city", "event_date").unionAll(_served(moved, days)).distinct()
        send(_averages(asked, sums.before(batch_id + 1), concerts.before(batch_id + 1), unit, days), batch_id)
        for used in (path, changed_path):
            remove(spark, used)

    return both.writeStream.outputMode("append").foreachBatch(update)


def _changed(new: DataFrame, old: DataFrame) -> DataFrame:
    """Cells whose latest fare is new, with what that adds to the sum and the number of their day."""
    held = old.select(*[F.col(c).alias(f"o_{c}") for c in CELL], F.struct("at", "price").alias("old"))
    same = [F.col(c).eqNullSafe(F.col(f"o_{c}")) for c in CELL]
    both = new.join(held, same, "left").where(F.col("old").isNull() | (F.struct("at", "price") > F.col("old")))

    total = F.col("price") - F.coalesce("old.price", F.lit(0))
    n = F.when(F.col("old").isNull(), 1).otherwise(0).cast("bigint")
    return both.select(*CELL, "at", "price", total.alias("d_total"), n.alias("d_n"))


def _unlisted(new: DataFrame, old: DataFrame) -> DataFrame:
    held = old.select(*[F.col(c).alias(f"o_{c}") for c in CONCERT])
    return new.join(held, [F.col(c).eqNullSafe(F.col(f"o_{c}")) for c in CONCERT], "left_anti")


def _served(moved: DataFrame, days: int) -> DataFrame:
    """The dates that a city's fares of a day serve."""
    return moved.select(F.col("end_city").alias("event_city"), F.explode(days_after(F.col("flight_date"), days)).alias("event_date"))


def _averages(asked: DataFrame, sums: DataFrame, concerts: DataFrame, unit: float, days: int) -> DataFrame:
    key = ["event_city", "event_date"]
    counts = concerts.groupBy(*key).agg(F.count("*").alias("concerts"))
    held = asked.join(counts, key)
    each = held.withColumn("flight_date", F.explode(days_before(F.col("event_date"), days)))
    found = each.join(sums.withColumnRenamed("end_city", "event_city"), ["event_city", "flight_date"])
    by_key = found.groupBy(*key).agg(F.sum("total").alias("total"), F.sum("n").alias("n"), F.max("concerts").alias("concerts"))
    mean = F.col("total").cast("double") / F.col("n") / F.lit(unit)
    return by_key.select(*key, mean.alias("avg_price"), (F.col("n") * F.col("concerts")).alias("n"))
