import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from eventfares.operators.aggs import event_fare_avg
from eventfares.operators.joins import event_flights_window
from eventfares.operators.ordering import running_avg as batch_running_avg
from eventfares.plans import live
from eventfares.sources import feeds, parse, sinks
from eventfares.streaming import join, run, state

from .conftest import day

DATE = "2018-11-16"
NOON = dt.datetime(2018, 11, 1, 12, tzinfo=dt.timezone.utc).timestamp()


class Feeds:
    """Two feed folders whose files arrive at chosen seconds after noon."""

    def __init__(self, root):
        self.root = root
        for name in ("concerts", "fares"):
            (root / name).mkdir()

    def add(self, feed, name, *lines, second=None):
        path = self.root / feed / f"{name}.csv"
        path.write_text("".join(f"{line}\n" for line in lines))
        os.utime(path, (NOON + (name if second is None else second),) * 2)

    def __getattr__(self, name):
        return str(self.root / name)


@pytest.fixture
def folders(tmp_path):
    return Feeds(tmp_path)


def fare(city, date, price):
    return f"Paris,{city},{date},{price}"


def live_once(spark, folders, **options):
    options = {"interval": "20 seconds", "delay": "1 hour", **options}
    max_files = options.get("max_files")
    ingest(spark, folders, max_files=max_files)
    matching = live.start_matching(spark, folders.work, once=True, **options)
    matching.awaitTermination()
    each_record = options.get("each_record", False)
    live.start_averaging(
        spark, folders.work, folders.documents, once=True, max_files=max_files, each_record=each_record
    ).awaitTermination()
    return matching


def ingest(spark, folders, **options):
    for feed in ("concerts", "fares"):
        path = getattr(folders, feed)
        live.start_ingest(spark, feed, path, folders.work, once=True, **options).awaitTermination()


def test_bad_lines_are_kept_aside(spark, folders):
    folders.add("concerts", 1, "header,line,x,y", f"1,A,{DATE},Dublin")
    folders.add("fares", 2, "a,b", fare("Dublin", "2018-11-12", 10))
    ingest(spark, folders)
    rejects = live.rejects(spark, folders.work).collect()
    assert sorted((r.feed, r.line) for r in rejects) == [("concerts", "header,line,x,y"), ("fares", "a,b")]


def test_small_batches_lose_nothing(spark, folders):
    folders.add("concerts", 1, f"1,A,{DATE},Dublin")
    for second in range(2, 8):
        folders.add("fares", second, fare("Dublin", "2018-11-12", second))
    live_once(spark, folders, max_files=1)
    assert documents(spark, folders)[-1][3] == 4.5


def documents(spark, folders):
    found = spark.read.json(folders.documents)
    return sorted((r.batch, r.event_city, r.event_date, r.avg_price) for r in found.collect())


def test_only_what_arrives_together_meets(spark, folders):
    folders.add("concerts", 1, f"1,A,{DATE},Dublin", "broken line")
    folders.add("fares", 2, fare("Dublin", "2018-11-12", 10), fare("Dublin", "2018-11-11", 99))
    folders.add("fares", 19, fare("Dublin", "2018-11-15", 30), "a,b")
    folders.add("fares", 21, fare("Dublin", "2018-11-15", 500))
    folders.add("concerts", 41, f"2,B,{DATE},Dublin")
    live_once(spark, folders)
    assert documents(spark, folders) == [(0, "Dublin", "2018-11-16T00:00:00.000Z", 20.0)]


def test_restart_goes_on_from_the_checkpoint(spark, folders):
    folders.add("concerts", 1, f"1,A,{DATE},Dublin", f"2,B,{DATE},Rome")
    folders.add("fares", 2, fare("Dublin", "2018-11-12", 10), fare("Rome", "2018-11-12", 8))
    live_once(spark, folders)
    live_once(spark, folders)  # nothing new
    first = [
        (0, "Dublin", "2018-11-16T00:00:00.000Z", 10.0),
        (0, "Rome", "2018-11-16T00:00:00.000Z", 8.0),
    ]
    assert documents(spark, folders) == first

    # A later interval: the concert is sent again, and its fares add to the same average.
    folders.add("concerts", 41, f"1,A,{DATE},Dublin")
    folders.add("fares", 42, fare("Dublin", "2018-11-13", 40))
    live_once(spark, folders)
    assert documents(spark, folders) == [*first, (1, "Dublin", "2018-11-16T00:00:00.000Z", 25.0)]


def test_late_partner_within_the_delay_still_meets(spark, folders):
    folders.add("concerts", 1, f"1,A,{DATE},Dublin")
    live_once(spark, folders)
    folders.add("fares", 2, fare("Dublin", "2018-11-12", 10))
    live_once(spark, folders)
    assert [d[3] for d in documents(spark, folders)] == [10.0]


def test_rows_behind_the_watermark_are_counted(spark, folders):
    folders.add("concerts", 1000, f"1,A,{DATE},Dublin")
    folders.add("fares", 1000, fare("Dublin", "2018-11-12", 10))
    assert run.late_rows(live_once(spark, folders, delay="200 seconds")) == 0
    folders.add("concerts", 500, f"1,A,{DATE},Dublin")
    folders.add("fares", 501, fare("Dublin", "2018-11-12", 99))
    assert run.late_rows(live_once(spark, folders, delay="200 seconds")) > 0
    assert [d[3] for d in documents(spark, folders)] == [10.0]


def test_a_snapshot_closed_over_half_a_minute_meets_its_concerts(spark, folders):
    stamp = "snapshot=20181101120000"
    (folders.root / "fares" / stamp).mkdir()
    (folders.root / "concerts" / stamp).mkdir()
    folders.add("concerts", f"{stamp}/part-0", f"1,A,{DATE},Dublin", second=30)
    folders.add("fares", f"{stamp}/part-0", fare("Dublin", "2018-11-12", 10), second=1)
    folders.add("fares", f"{stamp}/part-1", fare("Dublin", "2018-11-12", 20), second=31)
    live_once(spark, folders)
    assert documents(spark, folders)[-1][3] == 15.0


def test_a_document_after_every_record(spark, folders):
    folders.add("concerts", 1, f"1,A,{DATE},Dublin", f"2,B,{DATE},Dublin")
    folders.add("fares", 2, fare("Dublin", "2018-11-12", 10), fare("Dublin", "2018-11-13", 40))
    live_once(spark, folders, each_record=True)
    found = [d[3] for d in documents(spark, folders)]
    assert sorted(found) in ([10.0, 25.0], [25.0, 40.0])  # the first of either fare, then both


@pytest.mark.parametrize("mode", [[], ["--each-record"]])
def test_the_whole_job_in_both_modes(spark, folders, mode, capsys):
    folders.add("concerts", 1, f"1,A,{DATE},Dublin", "broken")
    for second in (2, 3):
        folders.add("fares", second, fare("Dublin", "2018-11-12", 10 * second))
    live.main(
        [folders.concerts, folders.fares, folders.work, folders.documents, "--once", "--show",
         "--delay", "1 hour", "--max-files", "1", "--archive", folders.archive, *mode]
    )
    assert documents(spark, folders)[-1][1:] == ("Dublin", "2018-11-16T00:00:00.000Z", 25.0)
    assert live.rejects(spark, folders.work).count() == 1


def test_one_row_per_key_and_side_whatever_the_tasks(spark, folders):
    for k in range(12):
        folders.add("concerts", k, f"{k},A,{DATE},Dublin")
        folders.add("fares", k + 0.5, fare("Dublin", "2018-11-12", k))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
    try:
        ingest(spark, folders)
        totals = join.join_totals(*_streams(spark, folders), interval="20 seconds", delay="1 hour")
        run.run_once(join.write_matches(totals, f"{folders.root}/totals"), f"{folders.root}/ckpt")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.total, r.n) for r in spark.read.parquet(f"{folders.root}/totals").collect()] == [(12 * 66.0, 144)]


def test_both_stages_run_side_by_side(spark, folders):
    folders.add("concerts", 0.1, f"1,A,{DATE},Dublin")
    folders.add("fares", 0.2, fare("Dublin", "2018-11-12", 10))
    pace = {"interval": "1 second"}
    running = [
        live.start_ingest(spark, "concerts", folders.concerts, folders.work, **pace),
        live.start_ingest(spark, "fares", folders.fares, folders.work, **pace),
        live.start_matching(spark, folders.work, **pace),
        live.start_averaging(spark, folders.work, folders.documents, **pace),
    ]
    try:
        for query in running:
            query.processAllAvailable()
    finally:
        for query in running:
            query.stop()
    assert [d[1:] for d in documents(spark, folders)] == [
        ("Dublin", "2018-11-16T00:00:00.000Z", 10.0)
    ]


def _streams(spark, folders):
    return (
        parse.accepted(feeds.read_concerts_stream(spark, folders.concerts)),
        parse.accepted(feeds.read_flights_stream(spark, folders.fares)),
    )


@pytest.fixture
def crowded(folders):
    """A hot city and date, exact copies, two concerts on one key, several files."""
    folders.add("concerts", 1, *[f"{i},A,{DATE},Dublin" for i in range(3)], "9,B,2018-11-18,Rome")
    for second in (2, 3, 4):
        copies = [fare("Dublin", "2018-11-14", 7)] * 50
        folders.add("fares", second, *copies, fare("Dublin", "2018-11-15", second), fare("Rome", "2018-11-14", 5))
    return folders


def _batch(spark, folders):
    return (
        parse.accepted(parse.concerts(feeds.feed_lines(spark, folders.concerts))).drop("arrival"),
        parse.accepted(feeds.read_flights(spark, folders.fares)).drop("arrival"),
    )


@pytest.mark.parametrize("salts", [1, 4])
def test_matches_and_totals_agree_with_batch(spark, crowded, salts):
    options = {"interval": "1 minute", "delay": "1 hour"}
    pairs = join.join_feeds(*_streams(spark, crowded), salts=salts, **options).select(*state.KEY, "price", "weight")
    totals = join.join_totals(*_streams(spark, crowded), **options)
    for name, matches in (("pairs", pairs), ("totals", totals)):
        run.run_once(join.write_matches(matches, f"{crowded.root}/{name}"), f"{crowded.root}/ckpt-{name}")
    expected = {
        (r.event_city, r.event_date): (r.avg_price, r.n)
        for r in event_fare_avg(*_batch(spark, crowded)).collect()
    }
    assert expected[("Dublin", day(DATE))][1] == 3 * 153

    rows = spark.read.parquet(f"{crowded.root}/pairs")
    assert rows.count() < 30  # copies and concerts are weights
    mean = F.sum(F.col("price") * F.col("weight")) / F.sum("weight")
    by_pairs = rows.groupBy(*state.KEY).agg(mean, F.sum("weight"))
    assert {tuple(r[:2]): (pytest.approx(r[2]), r[3]) for r in by_pairs.collect()} == expected
    written = spark.read.parquet(f"{crowded.root}/totals")
    by_totals = state.running_avg(written)
    assert {tuple(r[:2]): (pytest.approx(r[2]), r[3]) for r in by_totals.collect()} == expected
    assert written.count() < 20  # sums, not pairs


def test_average_after_every_record(spark, crowded):
    options = {"interval": "1 minute", "delay": "1 hour"}
    pairs = join.join_feeds(*_streams(spark, crowded), **options).select(*state.KEY, "price", "weight")
    table = f"{crowded.root}/pairs"
    run.run_once(join.write_matches(pairs, table), f"{crowded.root}/ckpt-pairs")

    def go():
        stream = spark.readStream.schema(live.RECORD_SCHEMA).parquet(table)
        each = state.running_avg_per_record(stream)
        writer = each.writeStream.format("parquet").option("path", f"{crowded.root}/each")
        with state.rocksdb_state(spark):
            run.run_once(writer, f"{crowded.root}/ckpt-each")

    before = spark.conf.get(state.PROVIDER, None)
    go()
    assert spark.conf.get(state.PROVIDER, None) == before

    # Another interval, after a restart: counts go on.
    crowded.add("concerts", 121, f"1,A,{DATE},Dublin")
    crowded.add("fares", 122, fare("Dublin", "2018-11-14", 1000))
    again = join.join_feeds(*_streams(spark, crowded), **options).select(*state.KEY, "price", "weight")
    run.run_once(join.write_matches(again, table), f"{crowded.root}/ckpt-pairs")
    go()

    rows = spark.read.parquet(f"{crowded.root}/each").collect()
    matched = [r for r in spark.read.parquet(table).collect() if r.event_city == "Dublin"]
    dublin = sorted((r.n, r.avg_price) for r in rows if r.event_city == "Dublin")
    assert len(dublin) == len(matched) and len({n for n, _ in dublin}) == len(dublin)
    assert dublin[-1][0] == sum(r.weight for r in matched) == 3 * 153 + 1
    assert dublin[-1][1] == pytest.approx(sum(r.price * r.weight for r in matched) / dublin[-1][0])
    assert max(r.n for r in rows if r.event_city == "Rome") == 3


def test_last_running_average_is_the_average(spark, crowded):
    concerts, flights = _batch(spark, crowded)
    matches = event_flights_window(concerts, flights).withColumn("i", F.monotonically_increasing_id())
    running = batch_running_avg(matches, state.KEY, ["i"], "price")
    last = running.groupBy(*state.KEY).agg(F.max_by("avg_price", "n"), F.max("n")).collect()
    averages = event_fare_avg(concerts, flights).collect()
    assert {tuple(r[:2]): (pytest.approx(r[2]), r[3]) for r in last} == {
        (r.event_city, r.event_date): (r.avg_price, r.n) for r in averages
    }


def test_documents_can_go_elsewhere_and_replays_replace(spark, tmp_path):
    sent = []
    source = tmp_path / "in"
    totals = spark.createDataFrame([("Dublin", day(DATE), 30.0, 2)], "event_city string, event_date date, total double, n bigint")
    totals.write.parquet(str(source))
    stream = spark.readStream.schema(totals.schema).parquet(str(source))
    writer = sinks.write_documents(
        state.running_avg(stream), "", write=lambda docs, batch: sent.append((batch, docs.collect()))
    )
    run.run_once(writer, str(tmp_path / "a"))
    assert [(b, [tuple(r) for r in rows]) for b, rows in sent] == [
        (0, [("Dublin", "2018-11-16T00:00:00.000Z", 15.0)])
    ]

    # Two queries on fresh checkpoints stand for a batch run twice: its files are replaced.
    for checkpoint in ("b", "c"):
        writer = sinks.write_documents(state.running_avg(stream), str(tmp_path / "docs"))
        run.run_once(writer, str(tmp_path / checkpoint))
    lines = [r.value for r in spark.read.text(str(tmp_path / "docs")).collect()]
    assert lines == ['{"event_city":"Dublin","event_date":"2018-11-16T00:00:00.000Z","avg_price":15.0}']


def test_console(spark, folders):
    folders.add("concerts", 1, *[f"{i},A,{DATE},Dublin" for i in range(15)])
    stream = parse.accepted(feeds.read_concerts_stream(spark, folders.concerts))
    query = run.start(sinks.to_console(stream.select("concert_id")), folders.ckpt, once=True)
    query.awaitTermination()
    assert query.lastProgress["numInputRows"] == 15
    assert "ConsoleTable" in query.lastProgress["sink"]["description"]


def test_stream_leaves_out_the_expired_and_archives_what_it_has_read(spark, folders):
    def go():
        stream = parse.accepted(
            feeds.read_concerts_stream(
                spark, folders.concerts, retention_seconds=200, archive=folders.archive, max_files=1
            )
        )
        writer = stream.writeStream.format("parquet").option("path", folders.out)
        run.run_once(writer, folders.ckpt)
        return sorted(r.concert_id for r in spark.read.parquet(folders.out).collect())

    now = dt.datetime.now(dt.timezone.utc).timestamp() - NOON
    folders.add("concerts", "a", f"1,A,{DATE},Dublin", second=now)
    assert go() == [1]
    folders.add("concerts", "b", f"2,A,{DATE},Dublin", second=now - 400)
    folders.add("concerts", "c", f"3,A,{DATE},Dublin", second=now + 1)
    folders.add("concerts", "d", f"4,A,{DATE},Dublin", second=now + 2)
    assert go() == [1, 3, 4]
    assert not (folders.root / "concerts" / "a.csv").exists()


def test_processing_time_clock(spark, folders):
    folders.add("concerts", 1, f"1,A,{DATE},Dublin")
    stream = parse.accepted(feeds.read_concerts_stream(spark, folders.concerts))
    writer = stream.writeStream.format("parquet").option("path", folders.out)
    query = run.start(writer, folders.ckpt, interval="1 second")
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(folders.out).count() == 1
