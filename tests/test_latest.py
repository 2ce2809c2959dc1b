"""Live averages of the latest fares against the batch form over all that has come."""

import random

import pytest

from eventfares.plans import batch, live
from eventfares.streaming import latest, run

from .test_streaming import Feeds, fare


@pytest.fixture
def folders(tmp_path):
    return Feeds(tmp_path)


def documents(spark, folders, out="documents"):
    """The last document of each key."""
    found = {}
    for r in spark.read.json(f"{folders.root}/{out}").orderBy("batch").collect():
        found[r.event_city, r.event_date[:10]] = r.avg_price
    return found


def expected(spark, folders):
    rows = batch.average_fares(spark, folders.concerts, folders.fares, latest_only=True).collect()
    return {(r.event_city, str(r.event_date)): pytest.approx(r.avg_price) for r in rows}


def step(spark, folders, **options):
    for feed in ("concerts", "fares"):
        live.start_ingest(spark, feed, getattr(folders, feed), folders.work, once=True, **options).awaitTermination()
    live.start_latest(spark, folders.work, folders.documents, once=True, **options).awaitTermination()


def test_a_changed_fare_takes_its_old_price_back(spark, folders):
    folders.add("concerts", 1, "1,A,2018-11-16,Dublin", "2,B,2018-11-16,Dublin")
    folders.add("fares", 2, fare("Dublin", "2018-11-14", 100), fare("Dublin", "2018-11-15", 40))
    step(spark, folders)
    assert documents(spark, folders) == {("Dublin", "2018-11-16"): 70.0}
    folders.add("fares", 3, fare("Dublin", "2018-11-14", 20))
    step(spark, folders)
    assert documents(spark, folders) == {("Dublin", "2018-11-16"): 30.0}
    folders.add("fares", 2.5, fare("Dublin", "2018-11-14", 999))  # out of order: a newer price is known
    folders.add("concerts", 4, "1,A,2018-11-16,Dublin", "3,A,2018-11-17,Dublin")
    step(spark, folders)
    assert documents(spark, folders) == {("Dublin", "2018-11-16"): 30.0, ("Dublin", "2018-11-17"): 30.0}


def test_as_the_batch_form_after_every_step(spark, folders):
    pick, second = random.Random(2), 0
    cities = ["Dublin", "Rome", "Oslo"]
    for _ in range(4):
        for _ in range(3):
            second += 1
            dates = [f"2018-11-{d:02}" for d in range(1, 9)]
            folders.add("concerts", second, *[f"{pick.randrange(9)},{pick.choice('AB')},{pick.choice(dates)},{pick.choice(cities)}" for _ in range(3)])
            folders.add("fares", second, *[fare(pick.choice(cities), pick.choice(dates), pick.randrange(5)) for _ in range(12)])
        step(spark, folders, max_files=2)
        found = documents(spark, folders)
        assert found == expected(spark, folders) and found


def test_a_batch_that_runs_again_changes_nothing(spark, folders):
    for k in range(4):
        folders.add("concerts", k, f"{k},A{k},2018-11-16,Dublin")
        folders.add("fares", k, fare("Dublin", "2018-11-14", 10 * k), fare("Dublin", f"2018-11-{12 + k % 2}", k))
    step(spark, folders, max_files=1)
    once = documents(spark, folders)
    # A fresh checkpoint on the state that is there: every batch runs again.
    both = latest.feeds_as_one(*[live._accepted(spark, f, folders.work, 1) for f in ("concerts", "fares")])
    sent = []
    writer = latest.write_latest_averages(both, f"{folders.work}/latest", lambda rows, batch: sent.append((batch, rows.collect())), merge_every=2)
    run.run_once(writer, f"{folders.root}/again")
    again = {(r.event_city, str(r.event_date)): r.avg_price for _, rows in sorted(sent) for r in rows}
    assert again == once == expected(spark, folders)
    _, sums, concerts = latest.tables(spark, f"{folders.work}/latest", "double")
    assert concerts.before(99).count() == 4 and {r.n for r in sums.before(99).collect()} == {1}


def test_the_whole_job_with_latest_fares(spark, folders):
    folders.add("concerts", 1, "1,A,2018-11-16,Dublin", "broken")
    folders.add("fares", 2, fare("Dublin", "2018-11-14", 100))
    folders.add("fares", 3, fare("Dublin", "2018-11-14", 60))
    live.main([folders.concerts, folders.fares, folders.work, folders.documents, "--once", "--latest", "--max-files", "1"])
    assert documents(spark, folders) == {("Dublin", "2018-11-16"): 60.0}
