"""Operators that follow one total order: dense numbers and running averages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventfares.settings import keep, new_path, remove

_POSITION_BITS = 33  # monotonically_increasing_id() holds the partition above, the row below
_SCANNED = "_scanned"


def number_rows(
    df: DataFrame, *order: str, name: str = "concert_id", start: int = 0, parts: int | None = None
) -> DataFrame:
    """Add dense row numbers in the given order, without passing the rows through one task.

    Rows are range-partitioned and sorted once, each with its place in its partition, and written.
    The number is that place plus the row count of all earlier partitions. Rows that tie are
    numbered in the order they were scanned, and may be split over partitions like any others.
    """
    full_order = [*order, _SCANNED]
    placed = _ranged(
        df,
        full_order,
        parts,
        lambda ranged: ranged.sortWithinPartitions(*full_order)
        .drop(_SCANNED)
        .withColumn("_place", F.monotonically_increasing_id()),
    ).withColumn("_part", F.shiftright("_place", _POSITION_BITS))

    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, so at most `parts` rows: fit for a single window and for a broadcast.
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    in_part = F.col("_place") - F.shiftleft("_part", _POSITION_BITS)
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + in_part + F.lit(start))
        .drop("_part", "_place", "_before")
    )


def running_avg(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    unit: float = 1.0,
    parts: int | None = None,
) -> DataFrame:
    """Add `n` and `avg_price`: count and mean of `value` over the key's rows up to this one.

    Rows are range-partitioned by (key, order), so that no task holds a whole key, however hot. Each
    partition runs its own window per key, and the sums of the key's earlier partitions are added.
    Rows of a key that tie come in the order they were scanned.
    """
    full_order = [*order, _SCANNED]
    placed = _ranged(
        df, [*keys, *full_order], parts, lambda ranged: ranged.withColumn("_part", F.spark_partition_id())
    )
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # A key has at most one row per partition here, and only keys that cross a boundary have several.
    before = (
        placed.groupBy(*keys, "_part")
        .agg(F.sum(value).alias("_sum"), F.count(value).alias("_count"))
        .select(
            *[F.col(c).alias(f"_at_{c}") for c in [*keys, "_part"]],
            F.sum("_sum").over(earlier).alias("_total_before"),
            F.sum("_count").over(earlier).alias("_n_before"),
        )
        .where("_n_before is not null")
    )
    so_far = (
        Window.partitionBy("_part", *keys)
        .orderBy(*full_order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    local = placed.withColumn("_total", F.sum(value).over(so_far)).withColumn("n", F.count(value).over(so_far))
    match = [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in [*keys, "_part"]]
    total = F.coalesce(F.col("_total_before") + F.col("_total"), "_total", "_total_before").cast("double")
    # Kept, as few keys cross a boundary: their true size decides how they are joined.
    joined = local.join(keep(before, "offsets"), match, "left")
    n = F.col("n") + F.coalesce("_n_before", F.lit(0))
    return joined.select(
        *df.columns, n.alias("n"), (F.try_divide(total, n) / F.lit(unit)).alias("avg_price")
    )


def _ranged(df: DataFrame, order: list[str], parts: int | None, shape) -> DataFrame:
    """`shape` of the rows in ranges of `order`, written.

    The rows are written as they come first, and each gets its place there, which breaks ties
    between copies: a scan gives the same places whenever it is repeated, as when a lost task runs
    again, and rows that come out of a shuffle would not. It also spares working out `df` a second
    time to sample it for range bounds. That first table is removed once the second is written.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = new_path(spark, "to-range")
    df.write.parquet(first)
    scanned = spark.read.schema(df.schema).parquet(first).withColumn(_SCANNED, F.monotonically_increasing_id())
    ranged = keep(shape(scanned.repartitionByRange(parts, *order)), "ranged")
    remove(spark, first)
    return ranged
