"""Fixed values of the feeds, and the session settings and shared storage the jobs rely on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# The feeds' own constants, which results depend on.
EVENT_CITIES = (
    "Berlin, Germany",
    "Paris, France",
    "Amsterdam, Netherlands",
    "Barcelona, Spain",
    "Copenhagen, Denmark",
    "Dublin, Ireland",
    "Prague, Czech Republic",
    "Rome, Italy",
    "Budapest, Hungary",
)
SEARCH_FROM = "2018-08-01"
SEARCH_TO = "2019-11-01"
FARE_START = "2018-10-31"
FARE_DAYS = 360
DAYS_BEFORE = 4
CAP_FACTOR = 2
PRESENCE_THRESHOLD = 0.1
RETENTION_SECONDS = 200
BATCH_INTERVAL = "22 seconds"
# A file past its retention is gone from the feed, so none arrives later than that.
ARRIVAL_DELAY = f"{RETENTION_SECONDS} seconds"
SHOWN_ROWS = 10

_local_dirs: dict[str, str] = {}
_paths: dict[str, list[str]] = {}


def session(app: str = "eventfares", **conf) -> SparkSession:
    """A session with the settings the jobs expect; `conf` overrides or adds to them."""
    options = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir`.

    Only a local session may go without that setting; it then gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    # Not local-cluster, whose executors are processes of their own.
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="eventfares-")
    return _local_dirs[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses; `clear` removes it."""
    path = f"{shared_dir(spark).rstrip('/')}/eventfares/{label}-{uuid.uuid4().hex}"
    _paths.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def _files(spark: SparkSession, path: str):
    """The file system that holds `path`, and the path there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def remove(spark: SparkSession, path: str) -> None:
    """Delete what is at a path of `new_path`."""
    files, at = _files(spark, path)
    files.delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at `path`."""
    files, at = _files(spark, path)
    return files.exists(at)


def rename(spark: SparkSession, path: str, target: str) -> None:
    """Give what is at `path` the name `target`, which nothing may have."""
    files, at = _files(spark, path)
    if not files.rename(at, _files(spark, target)[1]):
        raise FileExistsError(target)


def touch(spark: SparkSession, path: str) -> None:
    """Leave an empty file at `path`."""
    files, at = _files(spark, path)
    files.create(at, True).close()


def clear(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application. Results that read them must be written."""
    for path in _paths.pop(spark.sparkContext.applicationId, []):
        remove(spark, path)


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Every later use sees the same rows in the same files, whichever executors are lost meanwhile.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
