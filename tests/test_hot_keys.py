"""Salts of a stream's hot keys, by sketches of its last batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventfares.plans import live
from eventfares.streaming import hot, join, run

from .test_streaming import DATE, Feeds, fare, ingest

SINCE = dt.datetime(2020, 1, 1)


@pytest.fixture
def folders(tmp_path):
    return Feeds(tmp_path)


def sketched(spark, folder, *batches):
    """Sketches of batches of keys, each of so many records."""
    for k, batch in enumerate(batches):
        rows = [(key,) for key, n in batch.items() for _ in range(n)]
        spark.createDataFrame(rows, "city string").coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema("city string").parquet(f"{folder}/in")
        run.run_once(hot.write_sketches(stream, "city", f"{folder}/sketches"), f"{folder}/ckpt")
    return f"{folder}/sketches"


def test_shares_of_the_last_batches(spark, tmp_path):
    others = {f"city {k}": 1 for k in range(100)}
    path = sketched(spark, tmp_path, {"Oslo": 500}, {"Dublin": 100, **others}, {"Dublin": 50, "Rome": 50, None: 7})
    found = {r.key: r.share for r in hot.hot_keys(spark, path, last=2).collect()}
    assert found["Dublin"] == pytest.approx(0.5, abs=0.02) and found["Rome"] == pytest.approx(1 / 6, abs=0.02)
    assert "Oslo" not in found and len(found) <= hot.ITEMS
    assert hot.hot_keys(spark, f"{tmp_path}/none").count() == 0


def test_decisions_hold_from_their_time_on(spark, tmp_path):
    path, decisions = sketched(spark, tmp_path, {"Dublin": 60, **{f"c{k}": 1 for k in range(120)}}), f"{tmp_path}/salts"
    assert hot.decide(spark, path, decisions, 9, SINCE)["Dublin"] == 3
    assert hot.decide(spark, path, decisions, 9, SINCE + dt.timedelta(days=1))["Dublin"] == 3  # not written again
    sketched(spark, tmp_path, {"Dublin": 4000})
    day = dt.timedelta(days=1)
    assert hot.decide(spark, path, decisions, 9, SINCE + 2 * day)["Dublin"] == 9
    hours = [SINCE - day, SINCE, SINCE + day, SINCE + 2 * day, SINCE + 9 * day]
    asked = spark.createDataFrame([(c, h) for c in ("Dublin", "Rome", None) for h in hours], "city string, at timestamp")
    salts = hot.decided(spark, decisions)
    found = asked.select("city", "at", salts(F.col("city"), F.col("at")).alias("n")).collect()
    assert [r.n for r in found if r.city == "Dublin"] == [1, 3, 3, 9, 9]
    assert {r.n for r in found if r.city != "Dublin"} == {1}


def test_a_key_that_cools_down_gives_its_salts_back(spark, tmp_path):
    path, decisions = sketched(spark, tmp_path, {"Dublin": 60}), f"{tmp_path}/salts"
    hot.decide(spark, path, decisions, 4, SINCE)
    sketched(spark, tmp_path, {f"c{k}": 30 for k in range(60)})
    assert hot.decide(spark, path, decisions, 4, SINCE) == {"Dublin": 4}  # at that time it has its salts
    assert hot.decide(spark, path, decisions, 4, SINCE + dt.timedelta(days=1)) == {}
    salts = hot.decided(spark, decisions)
    now = spark.range(1).select(salts(F.lit("Dublin"), F.lit(SINCE + dt.timedelta(days=3))).alias("n"))
    assert now.first().n == 1


def crowd(folders, second, city="Dublin"):
    """A city with a third of the fares; each other city has few."""
    folders.add("concerts", second, *[f"{second}{i},A,{DATE},{c}" for i, c in enumerate([city, "Rome", *[f"c{k}" for k in range(20)]])])
    fares = [fare(city, "2018-11-14", k + 1) for k in range(100)] + [fare(f"c{k % 20}", "2018-11-15", k) for k in range(200)]
    folders.add("fares", second + 1, *fares)


def test_a_hot_city_goes_to_as_many_tasks_as_asked_and_loses_nothing(spark, folders):
    """The decision comes between two runs of one query; fares of both sides of it meet their concerts."""
    pace = {"interval": "20 seconds", "delay": "1 hour", "once": True, "each_record": True, "tasks": 12}
    for second in (1, 21, 41):
        crowd(folders, second)
        ingest(spark, folders)
        live.start_sketching(spark, folders.work, once=True).awaitTermination()
        live.start_matching(spark, folders.work, **pace).awaitTermination()
    # Partners of the first interval, from before any decision, come last.
    folders.add("fares", 5, fare("Dublin", "2018-11-14", 1000))
    ingest(spark, folders)
    live.start_matching(spark, folders.work, **pace).awaitTermination()
    salts = hot.decided(spark, f"{folders.work}/salts")
    at = F.lit(dt.datetime(2030, 1, 1))
    asked = spark.range(1).select(salts(F.lit("Dublin"), at).alias("hot"), salts(F.lit("c1"), at).alias("cold")).first()
    assert (asked.hot, asked.cold) == (4, 1)  # a third of 12
    matched = spark.read.parquet(f"{folders.work}/matches")
    found = sorted((r.event_city, r.price, r.weight) for r in matched.collect())
    expected = [("Dublin", k + 1.0, 1) for k in range(100)] * 3 + [("Dublin", 1000.0, 1)]
    expected += [(f"c{k % 20}", float(k), 1) for k in range(200)] * 3
    assert found == sorted(expected)


def test_rows_are_those_of_the_unsalted_join(spark, folders):
    crowd(folders, 1)
    crowd(folders, 3)
    ingest(spark, folders)
    salts = lambda city, start: F.when(city == "Dublin", 7).otherwise(1)
    rows = []
    for name, used in (("salted", salts), ("plain", 1)):
        both = [live._accepted(spark, feed, folders.work, None) for feed in ("concerts", "fares")]
        matches = join.join_feeds(*both, interval="1 minute", delay="1 hour", salts=used).select("event_city", "price", "weight")
        run.run_once(join.write_matches(matches, f"{folders.root}/{name}"), f"{folders.root}/ckpt-{name}")
        rows.append(sorted(map(tuple, spark.read.parquet(f"{folders.root}/{name}").collect())))
    assert rows[0] == rows[1] and len(rows[0]) == 300
