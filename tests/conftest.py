import datetime as dt
import os

import pytest

from eventfares.settings import session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {
        "spark.master": "local[8]",
        "spark.driver.memory": "6g",
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    spark = session("tests", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def sf_dir():
    return SF_DIR


def day(text):
    return dt.date.fromisoformat(text)


CONCERTS = "concert_id bigint, artist string, event_date date, event_city string"
FLIGHTS = "start_city string, end_city string, flight_date date, price double"


@pytest.fixture
def make_concerts(spark):
    """Concerts from (id, date, city)."""

    def make(*rows):
        return spark.createDataFrame(
            [(i, f"Artist {i}", day(d), city) for i, d, city in rows], CONCERTS
        )

    return make


@pytest.fixture
def make_flights(spark):
    """Flights from (start, end, date, price)."""

    def make(*rows):
        return spark.createDataFrame([(s, e, day(d), float(p)) for s, e, d, p in rows], FLIGHTS)

    return make
