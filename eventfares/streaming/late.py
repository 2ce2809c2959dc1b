"""The source rows that a query has dropped as too late, found by its own log.

A query's checkpoint says which files each batch has read, and which watermark held in it. A record
was dropped if the interval it arrived in was over by then. So nothing has to be kept while the query
runs, and each late record is found as it came, not as a sum of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventfares.settings import exists
from eventfares.sources.feeds import ARRIVAL

MULTIPLE = "spark.sql.streaming.statefulOperator.allowMultiple"
READ = "path string, batchId bigint"
HELD = "batchWatermarkMs bigint"


@contextmanager
def one_watermark(spark: SparkSession) -> Iterator[None]:
    """Queries started within drop what is late by the watermark of the batch itself, which is what
    their log says. Otherwise a batch goes by the one before it, but not the first after a restart.
    Such queries have one stateful operator."""
    before = spark.conf.get(MULTIPLE, None)
    spark.conf.set(MULTIPLE, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(MULTIPLE)
        else:
            spark.conf.set(MULTIPLE, before)


def batches(spark: SparkSession, checkpoint: str) -> DataFrame:
    """`file, batch`: the files that each batch of a query has read, by name."""
    lines = spark.read.option("recursiveFileLookup", True).text(f"{checkpoint}/sources")
    entries = lines.select(F.from_json("value", READ).alias("entry")).where("entry.path is not null")
    # Merged logs repeat the entries of earlier ones.
    return entries.select(F.element_at(F.split("entry.path", "/"), -1).alias("file"), F.col("entry.batchId").alias("batch")).distinct()


def watermarks(spark: SparkSession, checkpoint: str) -> DataFrame:
    """`batch, watermark`: what had to be over for a record to be late in a batch."""
    lines = spark.read.text(f"{checkpoint}/offsets").select("value", F.col("_metadata.file_name").try_cast("bigint").alias("batch"))
    held = lines.select("batch", F.from_json("value", HELD)["batchWatermarkMs"].alias("ms")).where("ms is not null")
    return held.select("batch", F.timestamp_millis("ms").alias("watermark"))


def late_records(records: DataFrame, checkpoint: str, interval: str) -> DataFrame:
    """Those of `records` that the query at `checkpoint` has dropped, with its `batch` and `watermark`.

    The query runs in `one_watermark` and joins by `interval`, as `join.join_feeds` does. `records` are read from the files that the query reads. Its log goes back as far as
    `spark.sql.streaming.minBatchesToRetain` batches. What it has not read yet is not late.
    """
    spark = records.sparkSession
    if not exists(spark, f"{checkpoint}/sources"):
        return records.select("*", F.lit(None).cast("bigint").alias("batch"), F.lit(None).cast("timestamp").alias("watermark")).where("false")
    placed = records.withColumn("_file", F.col("_metadata.file_name"))
    # One row for each file and for each batch.
    read = batches(spark, checkpoint).join(watermarks(spark, checkpoint), "batch")
    found = placed.join(read, F.col("_file") == F.col("file")).drop("_file", "file")
    # A window cannot be told from a plain column in a filter, so it is worked out first.
    ended = found.withColumn("_over", F.window(ARRIVAL, interval).end)
    return ended.where("_over <= watermark").drop("_over")
