"""Language identification by mixtures of languages."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventfares.llm.common import batch_of, map_arrow

FOLDS = 5
BINS = 1 << 15
DOCS_PER_LANGUAGE = 4000
SMOOTHING = 0.1
ROUNDS = 30
PENALTY = 3.0
UNKNOWN = "und"

_COUNTS = pa.schema([("lang", pa.string()), ("counts", pa.binary())])
_LETTER = re.compile(r"[^\W\d_]")
# Bytes that are no part of a word count as one blank each.
_CLEAN = np.arange(256, dtype=np.uint32)
_CLEAN[[b for b in range(128) if not chr(b).isalpha()]] = 32


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the fold that nothing is learned from. A null id counts as ''."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % FOLDS == 0


def train(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages, and for each the log-likelihood of every n-gram bin.

    Learned from `docs(doc_id, text, lang)` outside the held-out fold with a text and a language. Of
    a language with more than `docs_per_language` documents about that many are used, chosen by a
    hash of the id. What reaches the driver is one array of `BINS` counts per language.
    """
    known = docs.where(~held_out(F.col("doc_id")) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.least(F.lit(1.0), docs_per_language / F.col("n"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    sample = known.join(F.broadcast(sizes), "lang").where(draw < share).select("text", "lang")
    # Few tasks, as each leaves an array per language.
    parts = map_arrow(sample.repartition(16), _count, _COUNTS)
    totals = parts.groupBy("lang").applyInArrow(_add, "lang string, counts binary").collect()
    totals = sorted((r.lang, np.frombuffer(r.counts, np.int64)) for r in totals)
    if not totals:
        return [], np.zeros((0, BINS))
    counts = np.stack([c for _, c in totals]) + SMOOTHING
    return [lang for lang, _ in totals], np.log(counts / counts.sum(axis=1, keepdims=True))


def _count(batches):
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            bins, n = grams(text)
            total = sums.setdefault(lang, np.zeros(BINS, np.int64))
            total[bins] += n
    if sums:
        yield batch_of(_COUNTS, list(sums), [s.tobytes() for s in sums.values()])


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c, np.int64) for c in table.column("counts").to_pylist())
    return pa.table({"lang": [table.column("lang")[0].as_py()], "counts": [total.tobytes()]}, schema=_COUNTS)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The bins of the byte trigrams of the whole text in lower case, and how often each occurs."""
    data = _CLEAN[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    code = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    code = code[(data[:-2] != 32) | (data[1:-1] != 32)]
    bins = (code * np.uint32(2654435761)) >> np.uint32(17)
    counts = np.bincount(bins, minlength=BINS)
    found = np.nonzero(counts)[0]
    return found, counts[found]


def mixture(logs: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Proportions of languages by expectation-maximisation, and the log-likelihood they reach.

    `logs` is languages by n-grams; the proportions start even.
    """
    top = logs.max(axis=0)
    likely = np.exp(logs - top)
    share = np.full(len(logs), 1 / len(logs))
    total = counts.sum()
    for _ in range(rounds):
        new = share * (likely @ (counts / (share @ likely))) / total
        done = np.abs(new - share).max() < 1e-4
        share = new
        if done:
            break
    return share, float(counts @ (np.log(share @ likely) + top))


def language_set(logs: np.ndarray, counts: np.ndarray) -> dict[int, float]:
    """The languages of a document and their proportions.

    Of the sets found by leaving out the least language one at a time, the one with the highest
    log-likelihood, less `PENALTY` times the logarithm of the number of n-grams for each further
    language.
    """
    price = PENALTY * np.log(counts.sum() + 1)
    single = logs @ counts
    best = int(single.argmax())
    chosen, score = {best: 1.0}, single[best]
    left = np.arange(len(logs))
    while len(left) > 1:
        share, fit = mixture(logs[left], counts)
        # No part of this set fits better than the set, and any has at least two languages.
        if fit - price <= score:
            break
        if fit - price * (len(left) - 1) > score:
            chosen, score = dict(zip(left.tolist(), share.tolist(), strict=True)), fit - price * (len(left) - 1)
        left = np.delete(left, share.argmin())
    return chosen


def identify(docs: DataFrame, languages: list[str], logs: np.ndarray) -> DataFrame:
    """`docs` with `lang_pred`, the language with the largest proportion, `score`, that proportion,
    and `lang_set`, the languages found.

    A null text, and one without a letter, is `und` with score 0 and no languages, as is any text if
    nothing was learned. Only the text is looked at. Ties go to the language first in order. All
    columns pass through but those with the names of new ones, which are replaced.
    """
    docs = docs.drop("lang_pred", "score", "lang_set")
    model = logs.astype(np.float32)

    @F.pandas_udf("lang_pred string, score double, lang_set array<string>")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [_predict(t, languages, model) for t in texts]
            yield pd.DataFrame(found, columns=["lang_pred", "score", "lang_set"])

    return docs.withColumn("_judged", judged("text")).select(*[F.col(f"`{c}`") for c in docs.columns], "_judged.*")


def _predict(text: str | None, languages: list[str], logs: np.ndarray):
    if not languages or text is None or not _LETTER.search(text):
        return UNKNOWN, 0.0, []
    bins, counts = grams(text)
    chosen = language_set(logs[:, bins].astype(float), counts.astype(float))
    first = max(chosen, key=lambda k: (chosen[k], -k))
    return languages[first], min(1.0, chosen[first]), [languages[k] for k in chosen]


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    languages, logs = train(docs)
    found = identify(docs.select("doc_id", "text"), languages, logs)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.array_join("lang_set", ",").alias("lang_set"))
