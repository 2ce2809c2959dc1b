import random

import pytest
from pyspark.sql import functions as F

from eventfares.operators.ordering import number_rows, running_avg

SCHEMA = "k string, o int, v bigint"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def expected(rows):
    out, seen = [], {}
    for k, o, v in sorted(rows, key=lambda r: r[1]):
        total, n = seen.get(k, (0, 0))
        if v is not None:
            total, n = total + v, n + 1
        seen[k] = (total, n)
        out.append((k, o, v, n, total / n if n else None))
    return sorted(out, key=str)


def found(df):
    return sorted([(r.k, r.o, r.v, r.n, r.avg_price) for r in df.collect()], key=str)


@pytest.fixture
def skewed():
    pick = random.Random(3)
    rows = [("hot" if pick.random() < 0.4 else pick.choice("abc"), o, pick.randrange(100)) for o in range(400)]
    rows[5] = ("hot", 5, None)
    return rows


@pytest.mark.parametrize("parts", [1, 4, 20, 100])
def test_running_avg_with_and_without_split_keys(spark, skewed, parts):
    df = table(spark, skewed)
    assert found(running_avg(df, ["k"], ["o"], "v", parts=parts)) == expected(skewed)


def test_running_avg_keeps_null_keys_and_leading_nulls(spark):
    rows = [(None, 1, None), (None, 2, 4), (None, 3, None), (None, 4, 8), ("a", 1, 5)]
    for parts in (1, 2, 5):
        df = table(spark, rows)
        assert found(running_avg(df, ["k"], ["o"], "v", parts=parts)) == expected(rows)


def test_a_hot_key_is_spread_over_tasks(spark):
    rows = [("hot", o, o) for o in range(2_000)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        averaged = running_avg(table(spark, rows), ["k"], ["o"], "v", parts=20)
        sizes = averaged.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1 and found(averaged) == expected(rows)


def test_numbers_are_dense_and_in_order(spark):
    rows = [(random.Random(i).choice("abcdef"), i, 0) for i in range(500)]
    numbered = number_rows(table(spark, rows), "k", "o", name="i", parts=7).orderBy("i").collect()
    assert [r.i for r in numbered] == list(range(500))
    assert [(r.k, r.o) for r in numbered] == sorted((k, o) for k, o, _ in rows)


def test_numbers_with_ties_and_copies_stay_dense(spark):
    rows = [("same", 1, 1)] * 300 + [("z", 2, 2)]
    numbered = number_rows(table(spark, rows), "k", "o", name="i", start=1, parts=4)
    assert sorted(r.i for r in numbered.collect()) == list(range(1, 302))
    assert numbered.where("k = 'z'").first().i == 301


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert number_rows(empty, "k", name="i").count() == 0
    assert running_avg(empty, ["k"], ["o"], "v").count() == 0
