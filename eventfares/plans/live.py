"""The live job: two feed directories in, documents with the current average fares out.

Run by `eventfares_live.py CONCERTS FARES WORK DOCUMENTS`. Three steps, each a query of its own that
hands a table under WORK on to the next: ingest (one per feed), matching, averaging.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventfares.schemas import CONCERTS, CORRUPT, FLIGHTS
from eventfares.settings import ARRIVAL_DELAY, BATCH_INTERVAL, clear, exists, session
from eventfares.sources import feeds
from eventfares.sources.sinks import batches_to, folders, print_rows, to_console, to_documents, write_documents
from eventfares.streaming.averages import write_each_average
from eventfares.streaming.hot import Salts, decide, decided, write_sketches
from eventfares.streaming.join import join_feeds, join_totals, write_matches
from eventfares.streaming.late import batches, late_records, one_watermark
from eventfares.streaming.latest import feeds_as_one, write_latest_averages
from eventfares.streaming.run import LateRows, start
from eventfares.streaming.state import running_avg

READERS = {"concerts": feeds.read_concerts_stream, "fares": feeds.read_flights_stream}
RECORDS = {"concerts": CONCERTS, "fares": FLIGHTS}
MATCH_SCHEMA = "event_city string, event_date date, total double, n bigint"
RECORD_SCHEMA = "event_city string, event_date date, price double, weight bigint"


def start_ingest(
    spark: SparkSession,
    feed: str,
    path: str,
    work: str,
    interval: str = BATCH_INTERVAL,
    once: bool = False,
    max_files: int | None = None,
    retention_seconds: int | None = None,
    archive: str | None = None,
) -> StreamingQuery:
    """Read a feed's lines once, to a table of its records. Lines that do not parse are kept in it."""
    options = {"retention_seconds": retention_seconds, "archive": archive, "max_files": max_files}
    records = READERS[feed](spark, path, **options)
    marked = records.withColumn("rejected", F.col(CORRUPT).isNotNull().cast("int"))
    writer = marked.writeStream.format("parquet").partitionBy("rejected")
    target = writer.option("path", f"{work}/records/{feed}")
    return start(target, f"{work}/checkpoints/{feed}", interval, once)


def rejects(spark: SparkSession, work: str) -> DataFrame:
    """Lines of either feed that did not parse: `feed, arrival, line`."""
    found = [
        spark.read.parquet(f"{work}/records/{feed}")
        .where("rejected = 1")
        .select(F.lit(feed).alias("feed"), feeds.ARRIVAL, F.col(CORRUPT).alias("line"))
        for feed in READERS
    ]
    return found[0].unionByName(found[1])


def _accepted(spark: SparkSession, feed: str, work: str, max_files: int | None) -> DataFrame:
    schema = f"{RECORDS[feed]}, {CORRUPT} string, {feeds.ARRIVAL} timestamp, rejected int"
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    records = reader.parquet(f"{work}/records/{feed}")
    return records.where("rejected = 0").drop("rejected", CORRUPT)


def start_matching(
    spark: SparkSession,
    work: str,
    interval: str = BATCH_INTERVAL,
    delay: str = ARRIVAL_DELAY,
    once: bool = False,
    max_files: int | None = None,
    each_record: bool = False,
    tasks: int | None = None,
) -> StreamingQuery:
    """Tables of records to a table of matches: totals, or with `each_record` a row per fare and date.

    `max_files` bounds what a batch reads of each table. The join waits for the slower feed: rows
    leave its state by the earlier of both feeds' times. With `each_record`, a city with a share of
    the fares (see `start_sketching`) is dealt out over that share of `tasks`, by default as many as
    a shuffle has. Shares are looked at when the query starts.
    """
    both = [_accepted(spark, feed, work, max_files) for feed in READERS]
    pace = {"interval": interval, "delay": delay}
    if each_record:
        tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
        salts = _salts(spark, work, interval, tasks)
        matches = join_feeds(*both, salts=salts, **pace).select("event_city", "event_date", "price", "weight")
    else:
        matches = join_totals(*both, **pace)
    keep_late(spark, work, interval)
    writer = write_matches(matches, f"{work}/matches")
    with one_watermark(spark):
        return start(writer, f"{work}/checkpoints/matches", interval, once)


def keep_late(spark: SparkSession, work: str, interval: str = BATCH_INTERVAL) -> None:
    """Write what matching has dropped as too late since this was last asked to the table of late
    records: `feed, arrival, record, reason`, the record as JSON."""
    checkpoint, kept = f"{work}/checkpoints/matches", f"{work}/late"
    if not exists(spark, f"{checkpoint}/sources"):
        return
    done = (folders(spark, kept, "upto") or [-1])[-1]
    upto = batches(spark, checkpoint).agg(F.max("batch")).first()[0]
    if upto is None or upto <= done:
        return
    found = []
    for feed, fields in RECORDS.items():
        accepted = spark.read.schema(f"{fields}, {feeds.ARRIVAL} timestamp, rejected int").parquet(f"{work}/records/{feed}").where("rejected = 0")
        late = late_records(accepted, checkpoint, interval).where(F.col("batch") > done)
        record = F.to_json(F.struct(*[c for c in accepted.columns if c not in (feeds.ARRIVAL, "rejected")]))
        reason = F.concat(F.lit("arrived behind the watermark of "), F.date_format("watermark", "yyyy-MM-dd HH:mm:ss"))
        found.append(late.select(F.lit(feed).alias("feed"), feeds.ARRIVAL, record.alias("record"), reason.alias("reason")))
    found[0].unionByName(found[1]).write.mode("overwrite").parquet(f"{kept}/upto={upto}")


def late(spark: SparkSession, work: str) -> DataFrame:
    """The records that matching dropped as too late, as far as `keep_late` has been asked."""
    held = [f"{work}/late/upto={b}" for b in folders(spark, f"{work}/late", "upto")]
    schema = f"feed string, {feeds.ARRIVAL} timestamp, record string, reason string"
    return spark.read.schema(schema).parquet(*held) if held else spark.createDataFrame([], schema)


def start_sketching(
    spark: SparkSession, work: str, interval: str = BATCH_INTERVAL, once: bool = False, max_files: int | None = None
) -> StreamingQuery:
    """Sketch which cities the fares of each batch go to."""
    writer = write_sketches(_accepted(spark, "fares", work, max_files), "end_city", f"{work}/sketches")
    return start(writer, f"{work}/checkpoints/sketches", interval, once)


def _salts(spark: SparkSession, work: str, interval: str, tasks: int) -> Salts:
    """The salts decided so far, the shares of the last batches included from the next interval on."""
    decisions = f"{work}/salts"
    newest = None
    for feed in READERS:
        if not exists(spark, f"{work}/records/{feed}/_spark_metadata"):
            continue  # no batch has been read yet
        records = spark.read.schema(f"{feeds.ARRIVAL} timestamp, rejected int").parquet(f"{work}/records/{feed}")
        # Nothing has been read that arrived later than what the tables hold.
        last = records.agg(F.max(feeds.ARRIVAL).alias("last")).where("last is not null")
        for row in last.select(F.window("last", interval).end.alias("end")).collect():
            newest = row.end if newest is None else max(newest, row.end)
    if newest is not None:
        decide(spark, f"{work}/sketches", decisions, tasks, newest)
    return decided(spark, decisions)


def start_averaging(
    spark: SparkSession,
    work: str,
    documents: str,
    interval: str = BATCH_INTERVAL,
    once: bool = False,
    max_files: int | None = None,
    each_record: bool = False,
) -> StreamingQuery:
    """The table of matches to documents: one per changed key and batch, or one per record."""
    reader = spark.readStream.schema(RECORD_SCHEMA if each_record else MATCH_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    matches = reader.parquet(f"{work}/matches")
    checkpoint = f"{work}/checkpoints/averages"
    if not each_record:
        return start(write_documents(running_avg(matches), documents), checkpoint, interval, once)
    send = batches_to(documents, "json")
    writer = write_each_average(matches, f"{work}/sums/averages", lambda rows, batch: send(to_documents(rows), batch))
    return start(writer, checkpoint, interval, once)


def start_latest(
    spark: SparkSession,
    work: str,
    documents: str,
    interval: str = BATCH_INTERVAL,
    once: bool = False,
    max_files: int | None = None,
) -> StreamingQuery:
    """Tables of records to documents of the averages that count each concert once and each fare at
    its latest price, whenever either arrived. Takes the place of matching and averaging."""
    both = feeds_as_one(*[_accepted(spark, feed, work, max_files) for feed in READERS])
    send = batches_to(documents, "json")
    writer = write_latest_averages(both, f"{work}/latest", lambda rows, batch: send(to_documents(rows), batch))
    return start(writer, f"{work}/checkpoints/latest", interval, once)


def start_showing(
    spark: SparkSession, work: str, interval: str = BATCH_INTERVAL, once: bool = False, each_record: bool = False
) -> list[StreamingQuery]:
    """Print the first rows of each batch of concerts and of averages."""
    concerts = to_console(_accepted(spark, "concerts", work, None))
    if each_record:
        shown = spark.readStream.schema(RECORD_SCHEMA).parquet(f"{work}/matches")
        averages = write_each_average(shown, f"{work}/sums/shown", lambda rows, batch: print_rows(to_documents(rows)))
    else:
        totals = spark.readStream.schema(MATCH_SCHEMA).parquet(f"{work}/matches")
        averages = to_console(running_avg(totals), mode="update")
    return [
        start(writer, f"{work}/checkpoints/show-{name}", interval, once)
        for name, writer in (("concerts", concerts), ("averages", averages))
    ]


def main(arguments: list[str] | None = None) -> None:
    args = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    args.add_argument("concerts")
    args.add_argument("fares")
    args.add_argument("work")
    args.add_argument("documents")
    args.add_argument("--interval", default=BATCH_INTERVAL)
    args.add_argument("--delay", default=ARRIVAL_DELAY)
    args.add_argument("--max-files", type=int, help="most files a batch reads of each feed or table")
    args.add_argument("--retention", type=int, help="leave out what arrived so many seconds ago")
    args.add_argument("--archive", help="move feed files here once they have been read")
    args.add_argument("--each-record", action="store_true", help="a document after every record")
    args.add_argument("--tasks", type=int, help="with --each-record, tasks that fares are dealt out over")
    args.add_argument("--latest", action="store_true", help="count concerts once and fares at their latest price")
    args.add_argument("--show", action="store_true", help="print concerts and averages")
    args.add_argument("--once", action="store_true", help="process what is there, then stop")
    given = args.parse_args(arguments)

    spark = session("live-event-fares")
    pace = {"interval": given.interval, "once": given.once}
    bounded = {**pace, "max_files": given.max_files}

    def ingest() -> list[StreamingQuery]:
        return [
            start_ingest(
                spark, feed, path, given.work, retention_seconds=given.retention,
                archive=f"{given.archive}/{feed}" if given.archive else None, **bounded,
            )
            for feed, path in (("concerts", given.concerts), ("fares", given.fares))
        ]

    def sketch() -> list[StreamingQuery]:
        return [start_sketching(spark, given.work, **bounded)]

    def match() -> list[StreamingQuery]:
        return [
            start_matching(
                spark, given.work, delay=given.delay, each_record=given.each_record, tasks=given.tasks, **bounded
            )
        ]

    def average() -> list[StreamingQuery]:
        return [start_averaging(spark, given.work, given.documents, each_record=given.each_record, **bounded)]

    def latest() -> list[StreamingQuery]:
        return [start_latest(spark, given.work, given.documents, **bounded)]

    def show() -> list[StreamingQuery]:
        return start_showing(spark, given.work, each_record=given.each_record, **pace)

    steps = [ingest, latest] if given.latest else [ingest, *[sketch] * given.each_record, match, average]
    if given.show and not given.latest:
        steps.append(show)
    if not given.once:
        spark.streams.addListener(LateRows())
        for step in steps:
            step()
        spark.streams.awaitAnyTermination()
        return
    for step in steps:
        queries = step()
        for query in queries:
            query.awaitTermination()
    if not given.latest:
        before = late(spark, given.work).count()
        keep_late(spark, given.work, given.interval)
        if n_late := late(spark, given.work).count() - before:
            print(f"{n_late} records came too late to be matched")
    clear(spark)


if __name__ == "__main__":
    main()
