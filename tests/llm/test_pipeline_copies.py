import random

import corpus_pipeline
from eventfares.llm import lines
from eventfares.settings import keep

from . import test_langid
from .test_pipeline import DOCUMENTS


def line(k):
    return test_langid.text_of("aa", 12, k)


def three_stages(spark, folder, rows):
    docs = spark.createDataFrame([(i, t, "aa", "s", len(t)) for i, t in rows], DOCUMENTS)
    docs.write.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = keep(stage(spark, docs, str(folder)), name)
    return {r.doc_id: r.text for r in docs.collect()}


def test_one_document_of_each_copy_group_is_left(spark, tmp_path):
    pick, rows = random.Random(8), []
    for k in range(60):
        text = "\n".join(line(1000 + 20 * k + j) for j in range(pick.randrange(1, 9)))
        rows += [(1000 + 3 * k + j, text) for j in range(3)]
    held = three_stages(spark, tmp_path, rows)
    assert held == {i: t for i, t in rows if i % 3 == 1000 % 3}


def test_one_document_of_each_group_of_near_copies_is_left(spark, tmp_path):
    """Copies with a word changed in one or several lines, an inserted line, or a line less."""
    pick, rows, first = random.Random(9), [], []
    for k in range(40):
        parts = [line(5000 + 30 * k + j) for j in range(pick.randrange(10, 14))]
        first.append(len(rows) + 1)
        rows.append((len(rows) + 1, "\n".join(parts)))
        for kind in range(4):
            near = list(parts)
            at = pick.randrange(1, len(near) - 1)
            if kind < 2:
                for j in (at,) if kind == 0 else (0, at):
                    words = near[j].split(" ")
                    words[5] += "x"
                    near[j] = " ".join(words)
            elif kind == 2:
                near.insert(at, "inserted")
            else:
                del near[at]
            rows.append((len(rows) + 1, "\n".join(near)))
    pick.shuffle(rows)
    held = three_stages(spark, tmp_path, rows)
    assert sorted(held) == first
    assert all(held[i] == dict(rows)[i] for i in first)


def test_copies_with_null_and_repeated_ids(spark):
    text = "\n".join(line(k) for k in range(5))
    rows = [(5, text), (5, text), (9, text), (None, text), (None, text), (3, "other\nlines"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = lines.dedup_lines(docs).collect()
    left = sorted([(r.doc_id, r.text) for r in found], key=str)
    assert left == sorted([(5, text), (5, text), (9, ""), (None, ""), (None, ""), (3, "other\nlines"), (4, None)], key=str)
    assert all(r.lines_removed == (5 if r.text == "" else 0) for r in found)
    nulls = spark.createDataFrame([(None, text), (None, text)], "doc_id bigint, text string")
    assert [r.text for r in lines.dedup_lines(nulls).collect()] == [text, text]
