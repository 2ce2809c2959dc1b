import hashlib

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from eventfares.llm import bpe, langid, mixing
from eventfares.settings import keep

from . import test_jaccard, test_langid, test_lines

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def tables(spark, folder):
    rows = [(1, None), (2, "12 !")]
    rows += [(10 + k * 3 + j, test_langid.text_of(lang, 40, k * 3 + j)) for k in range(20) for j, lang in enumerate(("aa", "bb", "cc"))]
    block = "\n".join(f"repeated line {k} here" for k in range(8))
    rows += [(100 + k, f"{test_langid.text_of('aa', 20, 500 + k)}\n{block}\n{test_langid.text_of('aa', 20, 600 + k)}") for k in range(6)]
    rows += [(200 + k, rows[5][1] + f" end{k}") for k in range(5)] + [(300, rows[9][1])]
    langs = {10 + k * 3 + j: lang for k in range(20) for j, lang in enumerate(("aa", "bb", "cc"))}
    docs = spark.createDataFrame([(i, t, langs.get(i), "s", len(t or "")) for i, t in rows], DOCUMENTS)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i % 4 > 0), int(i % 7 == 0)) for i, _ in rows if i % 2]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return rows


def test_every_stage_against_brute_force(spark, tmp_path):
    rows = tables(spark, tmp_path)
    docs, stages = spark.read.parquet(f"{tmp_path}/documents.parquet"), dict(corpus_pipeline.STAGES)
    names, logs = langid.train(docs)
    columns = docs.columns

    def after(name):
        nonlocal docs
        docs = keep(stages[name](spark, docs, str(tmp_path)), "stage")
        return docs.collect()

    held = after("language_id")
    model = logs.astype(np.float32)
    expected = [(i, t) for i, t in rows if langid._predict(t, names, model)[0] != "und"]
    assert sorted((r.doc_id, r.text) for r in held) == sorted(expected) and len(expected) == len(rows) - 2

    held = after("line_dedup")
    expected = [(i, t) for i, t, cut in test_lines.expected(expected) if t or not cut]
    assert sorted((r.doc_id, r.text) for r in held) == sorted(expected) and docs.columns == columns
    assert all(r.n_chars == len(r.text) for r in held)
    assert sum("repeated line 3 here" in r.text for r in held) == 1

    held = after("jaccard_join")
    for judged in (rows, list(expected)):  # as they came, and as line dedup leaves them
        group, first = {i: c for i, _, c in test_jaccard.expected(judged)}, {}
        for i, _ in expected:
            first[group[i]] = min(first.get(group[i], i), i)
        expected = [(i, t) for i, t in expected if first[group[i]] == i]
    assert sorted((r.doc_id, r.text) for r in held) == sorted(expected) and docs.columns == columns
    assert not any(200 <= i < 205 for i, _ in expected)

    rated = {r.doc_id: r.rate for r in mixing.mix(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")).collect()}
    held = after("mixing")
    counts = {i: sum(r.doc_id == i for r in held) for i in rated}
    assert all(np.floor(rate) <= counts[i] <= np.floor(rate) + 1 for i, rate in rated.items()) and docs.columns == columns

    standard = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")),
    )
    last = after("byte_bpe")
    assert sorted((r.doc_id, r.ids) for r in last) == sorted((r.doc_id, standard.encode_ordinary(r.text)) for r in held)
    assert all(r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest() for r in last)


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_run_gives_what_the_stages_give(spark, tmp_path):
    tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, str(tmp_path)), "stage")
    ran = corpus_pipeline.run(spark, str(tmp_path))
    digest = lambda df: sorted(map(tuple, df.groupBy("doc_id", "ids_sha256").agg(F.count("*")).collect()))
    assert digest(ran) == digest(docs)
