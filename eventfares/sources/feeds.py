"""Readers of the concert and fare feeds: directories of CSV files, new snapshots beside old ones."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventfares.functions.scalars import COMPACT_STAMP, city_name
from eventfares.schemas import CONCERTS, CORRUPT
from eventfares.settings import RETENTION_SECONDS
from eventfares.sources import parse

ARRIVAL = "arrival"
# The folder that a snapshot's files are in carries its time, so that all of them arrive at once.
STAMPED = r"/snapshot=(\d{14})/"


def feed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line below `path`, with the time it arrived: its snapshot's, else its file's."""
    return _with_arrival(spark.read.option("recursiveFileLookup", True).text(path))


def feed_lines_stream(
    spark: SparkSession,
    path: str,
    retention_seconds: int | None = None,
    archive: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """The same lines as a stream that picks up new files.

    `retention_seconds` leaves out what arrived that long before the batch, snapshots whole;
    `archive` moves read files there; `max_files` bounds a batch.
    """
    reader = spark.readStream.option("recursiveFileLookup", True)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = _with_arrival(reader.text(path))
    if retention_seconds is None:
        return lines
    oldest = F.current_timestamp() - F.make_dt_interval(secs=F.lit(retention_seconds))
    return lines.where(F.col(ARRIVAL) >= oldest)


def read_concerts_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """Concert records as they arrive; see `parse.accepted` and `parse.rejected`."""
    return parse.concerts(feed_lines_stream(spark, path, **options))


def read_flights_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """Fare records as they arrive, full snapshots and changes alike."""
    return parse.flights(feed_lines_stream(spark, path, **options))


def read_flights(spark: SparkSession, path: str) -> DataFrame:
    """All fare records below `path`, full snapshots and changes alike."""
    return parse.flights(feed_lines(spark, path))


def read_concerts(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Concert records from CSV with quoted `"City, Country"` values, the city reduced to its name."""
    # Without column pruning every record is checked against the whole schema, whatever is selected.
    raw = (
        spark.read.schema(f"{CONCERTS}, {CORRUPT} string")
        .options(header=header, columnPruning=False, **parse.CSV_OPTIONS)
        .csv(path)
    )
    read = F.concat_ws(",", "concert_id", "artist", "event_date", "event_city")
    checked = parse.complete(raw, CONCERTS, F.coalesce(CORRUPT, read))
    return checked.withColumn("event_city", city_name(F.col("event_city")))


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """The city list, one name per line."""
    return spark.read.text(path).withColumnRenamed("value", "city")


def recent_files(
    lines: DataFrame, now: datetime, seconds: int = RETENTION_SECONDS
) -> DataFrame:
    """Lines that arrived no more than `seconds` before `now`; a snapshot stays or goes as a whole."""
    oldest = F.lit(now - timedelta(seconds=seconds)).cast("timestamp")
    return lines.where(F.col(ARRIVAL) >= oldest)


def _with_arrival(lines: DataFrame) -> DataFrame:
    stamp = F.regexp_extract("_metadata.file_path", STAMPED, 1)
    stamped = F.when(stamp != "", F.to_timestamp(stamp, COMPACT_STAMP))
    arrival = F.coalesce(stamped, F.col("_metadata.file_modification_time"))
    return lines.select("value", arrival.alias(ARRIVAL))
