"""Writers: feed snapshots, the console, and result documents."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from eventfares.functions.scalars import instant_text, whole_price
from eventfares.operators.fares import CELL, positive
from eventfares.settings import SHOWN_ROWS, exists, remove, rename, touch

CONCERT_FIELDS = ["concert_id", "artist", "event_date", "event_city"]
STAMP = "%Y%m%d%H%M%S"


def write_feed(records: DataFrame, path: str, moment: datetime) -> str:
    """Add a headerless CSV snapshot to the feed directory; return where it went.

    The snapshot is written to a hidden folder, which no reader lists, and gets its name once all its
    files are there. So a stream on `path` reads all of a snapshot or nothing, where renaming a
    folder is one step, as it is on HDFS and on local disks. A moment that has a snapshot is an error.
    """
    spark = records.sparkSession
    name = f"snapshot={moment.strftime(STAMP)}"
    target, hidden = f"{path.rstrip('/')}/{name}", f"{path.rstrip('/')}/.{name}-{uuid.uuid4().hex}"
    if exists(spark, target):
        raise FileExistsError(target)
    records.write.option("emptyValue", "").csv(hidden)
    rename(spark, hidden, target)
    return target


def concert_snapshot(concerts: DataFrame) -> DataFrame:
    """Concert records in feed order."""
    return concerts.select(*CONCERT_FIELDS)


def fare_snapshot(flights: DataFrame, price: str = "price") -> DataFrame:
    """All existing fares in feed order, at whole prices."""
    return positive(flights, price).select(*CELL, whole_price(F.col(price)).alias("price"))


def fare_changes(changed: DataFrame) -> DataFrame:
    """Changed fares (see `fares.diff`) in feed order, rounded, with the decimal point kept."""
    return changed.where(F.col("new_price").isNotNull()).select(
        *CELL, F.bround("new_price", 0).cast("double").alias("price")
    )


def to_console(stream: DataFrame, mode: str = "append", rows: int = SHOWN_ROWS) -> DataStreamWriter:
    """Print the first rows of every batch."""
    return stream.writeStream.outputMode(mode).format("console").option("numRows", rows)


def print_rows(batch: DataFrame, rows: int = SHOWN_ROWS) -> None:
    """Print the first rows of a batch that a stream hands over."""
    batch.show(rows, truncate=False)


def to_documents(averages: DataFrame) -> DataFrame:
    """Averages as documents: the city, the date as ISO text, and the mean fare."""
    return averages.select(
        "event_city", instant_text(F.col("event_date")).alias("event_date"), "avg_price"
    )


def to_json_lines(documents: DataFrame) -> DataFrame:
    return documents.select(F.to_json(F.struct("*")).alias("value"))


def batches_to(path: str, form: str = "parquet") -> Callable[[DataFrame, int], None]:
    """Writes each batch to a folder of its own below `path`, which a replay of the batch replaces."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(form).save(f"{path.rstrip('/')}/batch={batch_id}")

    return write


def folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers of the folders `name=<number>` below `path` that were written to the end, in order."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at):
        return []
    found = [s.getPath().getName() for s in files.listStatus(at)]
    done = [f for f in found if f.startswith(f"{name}=") and files.exists(hadoop.Path(f"{path}/{f}/_SUCCESS"))]
    return sorted(int(f.split("=")[1]) for f in done)


def write_documents(
    averages: DataFrame,
    path: str,
    mode: str = "update",
    write: Callable[[DataFrame, int], None] | None = None,
) -> DataStreamWriter:
    """Send each batch of averages out as documents.

    By default a batch becomes JSON files under `path/batch=<id>`; a batch that is replayed after a
    failure replaces its own files, so no document appears twice. `write(documents, batch_id)`
    sends them elsewhere instead, such as through a search index's connector.
    """

    send = write or batches_to(path, "json")
    return averages.writeStream.outputMode(mode).foreachBatch(
        lambda batch, batch_id: send(to_documents(batch), batch_id)
    )


def sent_once(path: str, send: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """`send`, but not again for a batch that it has sent, by a ledger under `path`.

    For writers whose documents do not replace each other, such as a connector's. A batch is entered
    once `send` returns; so a batch that fails after that and is replayed is not sent twice, and one
    that fails before is sent again. A query has a ledger of its own, as it has a checkpoint.
    """

    def once(batch: DataFrame, batch_id: int) -> None:
        entry = f"{path.rstrip('/')}/batch={batch_id}"
        if exists(batch.sparkSession, entry):
            return
        send(batch, batch_id)
        touch(batch.sparkSession, entry)

    return once


DOCUMENT = "event_city string, event_date string, avg_price double"


def current_documents(spark: SparkSession, path: str) -> DataFrame:
    """The last document of each city and date among the batches that `write_documents` left."""
    path = path.rstrip("/")
    merged = folders(spark, f"{path}-current", "version")[-1:]
    later = [b for b in folders(spark, path, "batch") if not merged or b > merged[0]]
    found = spark.createDataFrame([], f"{DOCUMENT}, batch bigint")
    if merged:
        found = spark.read.schema(found.schema).parquet(f"{path}-current/version={merged[0]}")
    if later:
        rows = spark.read.schema(DOCUMENT).option("basePath", path).json([f"{path}/batch={b}" for b in later])
        batch = F.regexp_extract("_metadata.file_path", r"/batch=(\d+)/", 1).cast("bigint")
        found = found.unionByName(rows.withColumn("batch", batch))
    last = found.groupBy("event_city", "event_date").agg(F.max_by(F.struct("avg_price", "batch"), "batch").alias("_last"))
    return last.select("event_city", "event_date", "_last.avg_price", "_last.batch")


def compact_documents(spark: SparkSession, path: str) -> None:
    """Merge the batches so far into one table beside `path`, one row per city and date.

    Readers of `current_documents` take the newest table that is written to the end, and the batches
    after it. The table before stays for those who have begun to read it; older ones go.
    """
    path = path.rstrip("/")
    batches = folders(spark, path, "batch")
    merged = folders(spark, f"{path}-current", "version")
    if not batches or merged and batches[-1] <= merged[-1]:
        return
    current_documents(spark, path).write.mode("overwrite").parquet(f"{path}-current/version={batches[-1]}")
    for old in merged[:-1]:
        remove(spark, f"{path}-current/version={old}")
