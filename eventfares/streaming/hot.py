"""How many salts the keys of a stream need, by sketches of the keys of its last batches.

A batch leaves a sketch of its most frequent keys. What the sketches of the last batches say together
is turned into a number of salts for each hot key, and written down as a decision with the time it
holds from. Both sides of a join ask the same decisions by key and interval, so a row and its partners
have the same salts, whenever either arrives.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from eventfares.sources.sinks import batches_to, folders

ITEMS = 64  # keys that a sketch reports, and so the most that a decision has
TRACKED = 10 * ITEMS
LAST_BATCHES = 20
DECISION = "since timestamp, key string, salts int"

Salts = Callable[[Column, Column], Column]


def write_sketches(records: DataFrame, key: str, path: str) -> DataStreamWriter:
    """Leave a sketch of the `key` of each batch's records under `path`, of bounded size."""

    def sketch(batch: DataFrame, batch_id: int) -> None:
        keys = batch.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("key"))
        made = keys.agg(F.expr(f"approx_top_k_accumulate(key, {TRACKED})").alias("sketch"), F.count("*").alias("n"))
        batches_to(path)(made.where("n > 0"), batch_id)

    return records.writeStream.foreachBatch(sketch)


def hot_keys(spark: SparkSession, path: str, last: int = LAST_BATCHES) -> DataFrame:
    """`key, share`: the most frequent keys of the last batches, with their share of the records.

    At most `ITEMS` keys. A share may be too high by a part in `TRACKED` of all records.
    """
    batches = folders(spark, path, "batch")[-last:]
    if not batches:
        return spark.createDataFrame([], "key string, share double")
    sketches = spark.read.parquet(*[f"{path}/batch={b}" for b in batches])
    together = sketches.agg(F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch"), F.sum("n").alias("total"))
    found = together.select("total", F.explode(F.expr(f"approx_top_k_estimate(sketch, {ITEMS})")).alias("top"))
    return found.select(F.col("top.item").alias("key"), F.least(F.col("top.count") / F.col("total"), F.lit(1.0)).alias("share"))


def decide(spark: SparkSession, sketches: str, decisions: str, tasks: int, since: datetime) -> dict[str, int]:
    """Write down the salts of hot keys from `since` on, if they have changed, and return them.

    A key with a share of the records gets that share of `tasks`, and a salt for each. Nothing may
    have been read yet that belongs to an interval from `since` on.
    """
    found = {r.key: math.ceil(r.share * tasks) for r in hot_keys(spark, sketches).collect()}
    salts = {key: n for key, n in sorted(found.items()) if n > 1}
    made = _decisions(spark, decisions)
    if salts != (made[-1][1] if made else {}):
        if made and since <= made[-1][0]:
            return made[-1][1]  # that one has not come into force yet
        # A decision that all keys have one salt is a row without a key.
        rows = [(since, key, n) for key, n in salts.items()] or [(since, None, 1)]
        number = (folders(spark, decisions, "decision") or [-1])[-1] + 1
        spark.createDataFrame(rows, DECISION).coalesce(1).write.mode("overwrite").parquet(f"{decisions}/decision={number}")
    return salts


def _decisions(spark: SparkSession, path: str) -> list[tuple[datetime, dict[str, int]]]:
    numbers = folders(spark, path, "decision")
    if not numbers:
        return []
    read = spark.read.schema(DECISION).parquet(*[f"{path}/decision={n}" for n in numbers])
    found: dict[datetime, dict[str, int]] = {}
    for row in read.collect():
        held = found.setdefault(row.since, {})
        if row.key is not None:
            held[row.key] = row.salts
    return sorted(found.items())


def decided(spark: SparkSession, path: str) -> Salts:
    """The number of salts of a key in the interval that starts at a time, by all decisions so far."""
    made = _decisions(spark, path)

    def salts(key: Column, start: Column) -> Column:
        number = F.lit(1)
        for since, held in made:
            literals = [F.lit(x) for pair in held.items() for x in pair]
            own = F.coalesce(F.element_at(F.create_map(*literals), key), F.lit(1)) if held else F.lit(1)
            number = F.when(start >= F.lit(since), own).otherwise(number)
        return number

    return salts
