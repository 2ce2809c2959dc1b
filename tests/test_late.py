"""Records that matching dropped as too late, kept with their reason."""

import json

import pytest

from eventfares.plans import live
from eventfares.streaming import late, run

from .test_streaming import DATE, Feeds, documents, fare, ingest

PACE = {"interval": "20 seconds", "delay": "200 seconds", "once": True}


@pytest.fixture
def folders(tmp_path):
    return Feeds(tmp_path)


def arrive(spark, folders, *seconds, price=10):
    for second in seconds:
        folders.add("concerts", second, f"{second},A,{DATE},Dublin")
        folders.add("fares", second + 0.5, fare("Dublin", "2018-11-12", price))
    ingest(spark, folders)


def kept(spark, folders):
    rows = live.late(spark, folders.work).collect()
    assert all(r.reason.startswith("arrived behind the watermark of 2018-11-01") for r in rows)
    return sorted((r.feed, json.loads(r.record).get("concert_id") or json.loads(r.record).get("price")) for r in rows)


def test_every_late_record_is_kept_once(spark, folders):
    arrive(spark, folders, 1000)
    live.start_matching(spark, folders.work, **PACE).awaitTermination()
    live.keep_late(spark, folders.work, "20 seconds")
    assert kept(spark, folders) == []
    # The watermark is 800: an interval that ends by then is over.
    arrive(spark, folders, 500, 770, 785, 801, price=99)
    query = live.start_matching(spark, folders.work, **PACE)
    query.awaitTermination()
    assert run.late_rows(query) > 0
    live.keep_late(spark, folders.work, "20 seconds")
    expected = [("concerts", 500), ("concerts", 770), ("concerts", 785)] + [("fares", 99.0)] * 3
    assert kept(spark, folders) == expected
    live.keep_late(spark, folders.work, "20 seconds")
    assert kept(spark, folders) == expected
    matched = spark.read.parquet(f"{folders.work}/matches").collect()
    assert sorted((r.total, r.n) for r in matched) == [(10.0, 1), (99.0, 1)]


def test_batches_of_one_run_go_by_their_own_watermark(spark, folders):
    for second in (1000, 500, 400, 990):
        arrive(spark, folders, second, price=second)
    live.start_matching(spark, folders.work, max_files=1, **PACE).awaitTermination()
    live.keep_late(spark, folders.work, "20 seconds")
    found = kept(spark, folders)
    matched = {r.total / r.n for r in spark.read.parquet(f"{folders.work}/matches").collect()}
    assert {x for feed, x in found if feed == "fares"} == {400.0, 500.0} and matched == {1000.0, 990.0}


def test_nothing_has_run(spark, folders):
    live.keep_late(spark, folders.work)
    assert live.late(spark, folders.work).count() == 0
    records = spark.createDataFrame([], "price double, arrival timestamp")
    assert late.late_records(records, f"{folders.work}/none", "1 minute").count() == 0


def test_the_job_says_how_many(spark, folders, capsys):
    run_job = lambda: live.main([folders.concerts, folders.fares, folders.work, folders.documents, "--once", "--delay", "200 seconds", "--interval", "20 seconds"])
    folders.add("concerts", 1000, f"1,A,{DATE},Dublin")
    folders.add("fares", 1000, fare("Dublin", "2018-11-12", 10))
    run_job()
    folders.add("fares", 300, fare("Dublin", "2018-11-12", 10), fare("Dublin", "2018-11-12", 10))
    run_job()
    assert "2 records came too late" in capsys.readouterr().out
    assert [d[3] for d in documents(spark, folders)] == [10.0]
