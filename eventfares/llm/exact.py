"""Exact duplicates by an extendible-hash index kept in shared files.

The index has a directory of `2 ** depth` cells, addressed by the leading bits of a text's hash, and
buckets that each serve one or more neighbouring cells. A bucket that would hold more than its
capacity is split by its next bit, and the directory doubles while any bucket needs it. Owner tasks
each hold a range of the hash keys. Texts whose hashes are equal are chained in their bucket and told
apart by their bytes.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventfares.llm.common import batch_of, map_arrow
from eventfares.settings import keep, new_path

BUCKET_BYTES = 4 << 20
OWNER_BYTES = 64 << 20
MAX_DEPTH = 20  # bounds the directory, which is broadcast, to 2 ** 20 short rows
KEY_BITS = 63

_MARKS = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("sha", pa.binary()), ("n_bytes", pa.int64())])
_ENTRIES = pa.schema(
    [
        ("key", pa.int64()),
        ("sha", pa.binary()),
        ("norm", pa.binary()),
        ("keep_id", pa.int64()),
        ("n", pa.int64()),
    ]
)


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: `doc_id, keep_id, group_size, kept, text_sha256`.

    Texts are equal when they are the same bytes after A-Z is lower-cased; a null text is an empty
    one. Of equal texts the row with the largest id stays. Rows that repeat the largest id all stay,
    as nothing tells them apart. A null id ranks below all others; a group without any id has a null
    `keep_id` and keeps its rows. No documents give no rows; other columns are not looked at.
    """
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    marks = keep(map_arrow(docs, _marks, _MARKS), "marks")
    index = build_index(docs, marks)
    found = marks.select("doc_id", "sha").join(index.select("sha", "keep_id", "group_size"), "sha")
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def build_index(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """Write the index of `docs(doc_id, text)` to shared files and read it back.

    One row per different text: `bucket, local_depth, key, slot, sha, n_bytes, keep_id, group_size,
    norm`. `slot` is the text's place in the chain of its key. Each owner's file is in key order.
    """
    spark = docs.sparkSession
    # Copies count once: a split cannot part them.
    texts = marks.groupBy("key", "sha").agg(F.max("n_bytes").alias("n_bytes"))
    texts = keep(texts.groupBy(cell_of(F.col("key"), MAX_DEPTH).alias("cell")).agg(F.sum("n_bytes").alias("n_bytes")), "cells")
    total = texts.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    depth = min(MAX_DEPTH, max(1, (4 * total // BUCKET_BYTES).bit_length()))
    owners = int(total // OWNER_BYTES) + spark.sparkContext.defaultParallelism
    cells = texts.groupBy(F.expr(f"shiftright(cell, {MAX_DEPTH - depth})").alias("cell")).agg(F.sum("n_bytes").alias("n_bytes"))
    places = directory(cells, depth).withColumn(
        "owner", F.floor(F.col("bucket") * owners / (1 << depth)).cast("int")
    )

    entries = map_arrow(docs, _combine, _ENTRIES)
    placed = entries.withColumn("cell", cell_of(F.col("key"), depth)).join(F.broadcast(places), "cell")
    chains = (
        placed.repartitionById(owners, "owner")  # a task for each owner
        .groupBy("owner", "bucket", "local_depth", "key", "norm")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"), F.first("sha").alias("sha"))
    )
    chain = Window.partitionBy("owner", "bucket", "key").orderBy("sha")
    path = new_path(spark, "hash-index")
    index = chains.withColumn("slot", F.row_number().over(chain)).select(
        "bucket", "local_depth", "key", "slot", "sha", F.octet_length("norm").alias("n_bytes"), "keep_id", "group_size", "norm"
    )
    index.write.parquet(path)
    return spark.read.schema(index.schema).parquet(path)


def cell_of(key, depth: int):
    """The leading `depth` bits of a key."""
    return F.shiftright(key, KEY_BITS - depth)


def directory(cells: DataFrame, depth: int, capacity: int = BUCKET_BYTES) -> DataFrame:
    """`(cell, bucket, local_depth)` for every cell in use of a directory of `depth` bits.

    Doubling stops, for a cell, at the first depth whose bucket holds at most `capacity` bytes, or
    at `depth`; a bucket is named by its first cell.
    """
    levels = cells.select("cell", "n_bytes", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level"))
    levels = levels.withColumn("bucket", F.expr(f"shiftleft(shiftright(cell, {depth} - level), {depth} - level)"))
    fits = levels.groupBy("level", "bucket").agg(F.sum("n_bytes").alias("held")).where((F.col("held") <= capacity) | (F.col("level") == depth))
    first = levels.join(fits, ["level", "bucket"]).groupBy("cell").agg(F.min(F.struct("level", "bucket")).alias("at"))
    return first.select("cell", F.col("at.bucket").alias("bucket"), F.col("at.level").alias("local_depth"))


def _lowered(batch) -> list[bytes]:
    text = batch.column(1)
    return [t or b"" for t in pc.ascii_lower(text).cast(pa.binary()).to_pylist()]


def _key(sha: bytes) -> int:
    return int.from_bytes(sha[:8], "big") >> (64 - KEY_BITS)


def _marks(batches):
    for batch in batches:
        texts = _lowered(batch)
        shas = [hashlib.sha256(t).digest() for t in texts]
        yield batch_of(_MARKS, batch.column(0), [_key(s) for s in shas], shas, [len(t) for t in texts])


def _combine(batches):
    """The different texts of each batch, so that a frequent text is sent once per batch."""
    for batch in batches:
        held: dict[bytes, list] = {}
        for doc_id, norm in zip(batch.column(0).to_pylist(), _lowered(batch), strict=True):
            entry = held.setdefault(norm, [None, 0])
            entry[1] += 1
            if doc_id is not None and (entry[0] is None or doc_id > entry[0]):
                entry[0] = doc_id
        shas = [hashlib.sha256(norm).digest() for norm in held]
        yield batch_of(_ENTRIES, [_key(s) for s in shas], shas, list(held), [e[0] for e in held.values()], [e[1] for e in held.values()])


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP3_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
"""
