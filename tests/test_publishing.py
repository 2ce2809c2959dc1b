"""Snapshots that appear whole, batches sent once, and documents merged into a current table."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from eventfares.sources import feeds, parse, sinks
from eventfares.streaming import run

MOMENT = dt.datetime(2018, 11, 1, 12)


def concerts(spark, n):
    return spark.range(n).select(
        F.col("id").alias("concert_id"), F.lit("A").alias("artist"), F.lit("2018-11-16").alias("event_date"), F.lit("Dublin").alias("event_city")
    )


def read(spark, path, checkpoint, out):
    stream = parse.accepted(feeds.read_concerts_stream(spark, path))
    run.run_once(stream.writeStream.format("parquet").option("path", out), checkpoint)
    return spark.read.parquet(out).count() if any(f.endswith(".parquet") for f in os.listdir(out)) else 0


def test_half_a_snapshot_is_not_seen(spark, tmp_path):
    path, out = f"{tmp_path}/concerts", f"{tmp_path}/out"
    first = sinks.write_feed(concerts(spark, 8).repartition(4), path, MOMENT)
    assert first == f"{path}/snapshot=20181101120000" and read(spark, path, f"{tmp_path}/c", out) == 8
    # A writer that was stopped half way: some of the parts, in the folder they are written to.
    half = f"{path}/.snapshot=20181101120100-0"
    concerts(spark, 6).repartition(3).write.csv(half)
    assert read(spark, path, f"{tmp_path}/c", out) == 8
    assert feeds.feed_lines(spark, path).count() == 8
    os.rename(half, f"{path}/snapshot=20181101120100")
    assert read(spark, path, f"{tmp_path}/c", out) == 14


def test_a_moment_has_one_snapshot(spark, tmp_path):
    sinks.write_feed(concerts(spark, 2), str(tmp_path), MOMENT)
    with pytest.raises(FileExistsError):
        sinks.write_feed(concerts(spark, 3), str(tmp_path), MOMENT)
    assert feeds.feed_lines(spark, str(tmp_path)).count() == 2


class Lost(Exception):
    pass


@pytest.mark.parametrize("when", ["before", "after"])
def test_no_document_twice_and_none_lost(spark, tmp_path, when):
    """The job ends before or after the second batch is sent, and is started again."""
    schema, sent, faults = "event_city string, event_date date, avg_price double", [], [1]
    for k in range(3):
        spark.sql(f"select 'c{k}' event_city, date'2018-11-16' event_date, {k}D avg_price").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def send(documents, batch_id):
        sent.append((batch_id, documents.collect()))

    once = sinks.sent_once(f"{tmp_path}/ledger", send)

    def faulty(documents, batch_id):
        fault = batch_id in faults
        if fault:
            faults.remove(batch_id)
        if fault and when == "before":
            raise Lost
        once(documents, batch_id)
        if fault and when == "after":
            raise Lost

    def go():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        run.run_once(sinks.write_documents(stream, "", mode="append", write=faulty), f"{tmp_path}/ckpt")

    with pytest.raises(Exception, match="Lost"):
        go()
    go()
    assert [b for b, _ in sent] == [0, 1, 2]
    assert sorted(r.event_city for _, rows in sent for r in rows) == ["c0", "c1", "c2"]


def documents(spark, path, batch, *rows):
    sinks.batches_to(path, "json")(spark.createDataFrame(rows, sinks.DOCUMENT), batch)


def test_one_current_document_after_any_number_of_batches(spark, tmp_path):
    path, expected = f"{tmp_path}/documents", {}
    for batch in range(9):
        rows = [("Dublin", "d1", float(batch)), (f"c{batch % 4}", "d1", batch + 0.5), (None, "d2", None if batch % 2 else 1.0)]
        documents(spark, path, batch, *rows)
        expected |= {r[:2]: (r[2], batch) for r in rows}
        if batch in (2, 3, 6):
            sinks.compact_documents(spark, path)
        found = [((r.event_city, r.event_date), (r.avg_price, r.batch)) for r in sinks.current_documents(spark, path).collect()]
        assert len(found) == len(dict(found)) and dict(found) == expected
    assert sorted(f for f in os.listdir(f"{path}-current")) == ["version=3", "version=6"]
    sinks.compact_documents(spark, path)
    sinks.compact_documents(spark, path)
    # A table that was not written to the end does not count.
    os.makedirs(f"{path}-current/version=99")
    assert {r.batch for r in sinks.current_documents(spark, path).collect()} == {b for _, b in expected.values()}


def test_no_documents_yet(spark, tmp_path):
    sinks.compact_documents(spark, f"{tmp_path}/none")
    assert sinks.current_documents(spark, f"{tmp_path}/none").count() == 0
