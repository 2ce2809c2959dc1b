import hashlib
import random

from pyspark.sql import functions as F

from eventfares.llm import exact

A_TO_Z = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def expected(rows):
    norm = [(i, (t or "").translate(A_TO_Z)) for i, t in rows]
    out = []
    for i, t in norm:
        ids = [j for j, u in norm if u == t]
        keep = max((j for j in ids if j is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()], key=str)


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, b"x") for i, t in rows], "doc_id bigint, text string, key int, sha binary")


def test_against_brute_force(spark):
    pick = random.Random(1)
    rows = [(i, pick.choice(["Ab", "aB", "É", "é", "", None, "x" * 200_000, f"t{i % 7}"])) for i in range(60)]
    rows += [(3, "ab"), (3, "ab"), (None, "ab"), (None, "alone"), (None, "alone")]
    assert found(exact.exact_duplicates(table(spark, rows).repartition(5))) == expected(rows)


def test_empty(spark):
    assert exact.exact_duplicates(table(spark, [])).count() == 0


def test_texts_of_one_key_are_told_apart_by_their_bytes(spark, monkeypatch):
    # Workers use their own copy of the module, so the key is narrowed where it is put to use.
    rows = [(i, f"text {i % 10}") for i in range(40)]
    docs = table(spark, rows).select("doc_id", "text")
    marks = exact.map_arrow(docs, exact._marks, exact._MARKS).withColumn("key", F.lit(1).cast("bigint"))
    real = exact.map_arrow
    monkeypatch.setattr(exact, "map_arrow", lambda *a: real(*a).withColumn("key", F.lit(1).cast("bigint")))
    index = exact.build_index(docs, marks)
    chain = index.orderBy("slot").collect()
    assert [r.slot for r in chain] == list(range(1, 11)) and {r.key for r in chain} == {1}
    assert sorted((r.norm.decode(), r.keep_id, r.group_size) for r in chain) == [(f"text {k}", 30 + k, 4) for k in range(10)]


def test_overfull_buckets_split_and_the_directory_doubles(spark):
    cells = spark.createDataFrame([(0, 60), (1, 50), (2, 10), (3, 10), (4, 5), (7, 5)], "cell bigint, n_bytes bigint")
    places = {r.cell: (r.bucket, r.local_depth) for r in exact.directory(cells, 3, capacity=60).collect()}
    assert places == {0: (0, 3), 1: (1, 3), 2: (2, 2), 3: (2, 2), 4: (4, 1), 7: (4, 1)}


def test_each_owner_task_has_a_range_of_buckets_of_its_own(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.repeat(F.col("id").cast("string"), 2000)).alias("text"))
    marks = exact.map_arrow(docs, exact._marks, exact._MARKS)
    index = exact.build_index(docs, marks)
    # A file is what an owner's task has written.
    files = index.groupBy(F.input_file_name().alias("file")).agg(F.min("bucket").alias("low"), F.max("bucket").alias("high"), F.count("*").alias("n"))
    ranges = sorted((r.low, r.high, r.n) for r in files.collect())
    assert sum(r[2] for r in ranges) == 6000
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert max(r[2] for r in ranges) < 2.5 * 6000 / len(ranges) and len(ranges) > 2
