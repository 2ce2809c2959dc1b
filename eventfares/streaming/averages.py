"""Running averages after every record, for streams in which one key may hold most records.

A batch's records of a key are dealt to sub-keys, one for each range of records that a scan task
reads. Every sub-key runs its own prefix of sums, in a task of its own if need be, and gets what came
before it as an offset: the sums of the key's earlier sub-keys, and of all earlier batches. Those are
kept as a table of additions, one small part for each batch, which are merged now and then.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from eventfares.settings import new_path, remove
from eventfares.streaming.parts import MERGE_EVERY, Parts
from eventfares.streaming.state import KEY

_POSITION_BITS = 33  # monotonically_increasing_id() holds the partition above, the row below


def write_each_average(
    matches: DataFrame,
    state: str,
    send: Callable[[DataFrame, int], None],
    unit: float = 1.0,
    merge_every: int = MERGE_EVERY,
) -> DataStreamWriter:
    """Send the averages after every record of each batch: `event_city, event_date, avg_price, n`.

    `matches` has a `price` for each record, and may have a `weight`, the records it stands for. One
    row comes out for each row in, with the average and count of its key up to there. Rows follow the
    order in which their batch is scanned. A null price counts as nothing, and its row has the average
    so far, null if there is none.

    `state` is a folder of the query's own, beside its checkpoint, in which a batch that is replayed
    replaces what it left. `send(averages, batch_id)` has to do the same.
    """
    state = state.rstrip("/")
    price = matches.schema["price"].dataType
    total = T.DecimalType(38, 0) if isinstance(price, T.IntegralType) else T.DoubleType()

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        sums = sums_of(spark, state, total)
        path = new_path(spark, "each-average")
        _places(batch, total).write.parquet(path)
        placed = spark.read.parquet(path)
        parts = placed.groupBy(*KEY, "part").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        parts_path = new_path(spark, "each-average-parts")
        parts.write.parquet(parts_path)
        parts = spark.read.parquet(parts_path)
        send(_averages(placed, _offsets(parts, sums.before(batch_id)), unit), batch_id)
        sums.add(sums.one(parts.drop("part")), batch_id, merge=batch_id % merge_every == merge_every - 1)
        for used in (path, parts_path):
            remove(spark, used)

    return matches.writeStream.outputMode("append").foreachBatch(each)


def _places(batch: DataFrame, total: T.DataType) -> DataFrame:
    """The records with their sub-key and their place in it. Written, so that both stay as they are."""
    known = F.col("price").isNotNull()
    weight = F.col("weight") if "weight" in batch.columns else F.lit(1)
    return batch.select(
        *KEY,
        (F.col("price").cast(total) * F.when(known, weight)).cast(total).alias("total"),
        F.when(known, weight).otherwise(0).cast("bigint").alias("n"),
        F.monotonically_increasing_id().alias("place"),
    ).withColumn("part", F.shiftright("place", _POSITION_BITS))


def _offsets(parts: DataFrame, before: DataFrame) -> DataFrame:
    """What comes before each sub-key: `total_before, n_before`. A key has a row for each scan task here."""
    earlier = Window.partitionBy(*KEY).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # What earlier batches left is a sub-key ahead of all others.
    sums = parts.unionByName(before.withColumn("part", F.lit(-1).cast("bigint")))
    offsets = sums.select(*KEY, "part", F.sum("total").over(earlier).alias("total_before"), F.sum("n").over(earlier).alias("n_before"))
    return offsets.where("part >= 0")


def _averages(placed: DataFrame, offsets: DataFrame, unit: float) -> DataFrame:
    # A sub-key's offset is a row ahead of its records: it meets them by the sort that their sums need
    # anyway, where a join would shuffle and sort all records again.
    rows = placed.unionByName(offsets.withColumn("place", F.lit(-1).cast("bigint")), allowMissingColumns=True)
    so_far = Window.partitionBy(*KEY, "part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    running = rows.select(
        *KEY, "place", *[F.sum(c).over(so_far).alias(c) for c in ("total", "n")],
        *[F.first(c).over(so_far).alias(c) for c in ("total_before", "n_before")],
    ).where("place >= 0")
    zero = F.lit(0)
    total = F.coalesce("total", zero).cast("double") + F.coalesce("total_before", zero).cast("double")
    n = F.col("n") + F.coalesce("n_before", zero)
    return running.select(*KEY, (F.try_divide(total, n) / F.lit(unit)).alias("avg_price"), n.cast("bigint").alias("n"))


def sums_of(spark: SparkSession, state: str, total: T.DataType) -> Parts:
    """The sums by key that all batches have left."""
    schema = f"event_city string, event_date date, total {total.simpleString()}, n bigint"
    return Parts(spark, state, schema, KEY, total=F.sum("total").cast(total), n=F.sum("n"))
