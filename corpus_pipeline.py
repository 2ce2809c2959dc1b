"""A training corpus from raw documents, in five stages."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventfares.llm import bpe, jaccard, langid, lines, mixing
from eventfares.settings import keep


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; those without one go."""
    found = langid.identify(docs, *langid.train(docs))
    return found.where(F.col("lang_pred") != langid.UNKNOWN).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of lines that occur before; documents that have nothing left go."""
    asked = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    found = lines.dedup_lines(asked).where("text <> '' or lines_removed = 0")
    n_chars = F.when(F.col("lines_removed") > 0, F.char_length("text")).otherwise(F.col("row.n_chars")).cast("bigint")
    new = {"text": F.col("text"), "n_chars": n_chars}
    return found.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of the smallest id.

    Line dedup leaves of a near copy the lines that differ, which are like nothing any more. So
    documents are judged twice: by their texts as they came, and by what is left of them. Only ids
    and groups are joined in between; texts are shuffled once, when documents go.
    """
    came = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    whole = keep(_later(ids, jaccard.near_duplicates(came)), "near-copies")
    left = ids.join(whole, "doc_id", "left_anti")
    gone = keep(whole.unionByName(_later(left, jaccard.near_duplicates(docs))), "near-copies")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def _later(ids: DataFrame, found: DataFrame) -> DataFrame:
    """Those of `ids` that share a group with a smaller one of them."""
    placed = ids.join(found.select("doc_id", "component_id").distinct(), "doc_id")
    first = placed.groupBy("component_id").agg(F.min("doc_id").alias("first"))
    return placed.join(first, "component_id").where("doc_id > first").select("doc_id")


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates have it."""
    mixed = mixing.mix(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mixing.draw(mixed, docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id, n_tokens, ids_sha256, decoded_sha256, ids` of each text."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.digests(docs, ranks, public_tokenizers.PATTERN, ids=True)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("mixing", mix_to_targets),
    ("byte_bpe", byte_bpe),
]

# Models, similarity joins and merges have no SQL; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each over what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
