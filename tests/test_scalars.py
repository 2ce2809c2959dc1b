import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventfares.functions import scalars

from .conftest import day


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, name",
    [("Dublin, Ireland", "Dublin"), ("Dublin", "Dublin"), (" Dublin ,x,y", " Dublin "), ("", ""), (None, None)],
)
def test_city_name(spark, text, name):
    assert value(spark, scalars.city_name(F.lit(text).cast("string"))) == name


@pytest.mark.parametrize("x, kept", [(0.05, 0.0), (0.1, 0.1), (0.5, 0.5), (-3.0, 0.0), (None, None)])
def test_zero_below(spark, x, kept):
    assert value(spark, scalars.zero_below(F.lit(x).cast("double"))) == kept


def test_days_before_and_after_mirror_each_other(spark):
    event = F.lit("2020-03-02").cast("date")
    before = value(spark, scalars.days_before(event))
    assert before == [day("2020-02-27"), day("2020-02-28"), day("2020-02-29"), day("2020-03-01")]
    for flight in before:
        assert day("2020-03-02") in value(spark, scalars.days_after(F.lit(flight)))


@pytest.mark.parametrize(
    "flight, inside",
    [("2018-11-11", False), ("2018-11-12", True), ("2018-11-15", True), ("2018-11-16", False)],
)
def test_in_window_edges(spark, flight, inside):
    concert = F.lit("2018-11-16").cast("date")
    assert value(spark, scalars.in_window(F.lit(flight).cast("date"), concert)) is inside


@pytest.mark.parametrize("x, whole", [(2.5, 2), (3.5, 4), (2.4, 2), (2.6, 3)])
def test_whole_price_rounds_halves_to_even(spark, x, whole):
    assert value(spark, scalars.whole_price(F.lit(x))) == whole


def test_instant_text(spark):
    assert value(spark, scalars.instant_text(F.lit(day("2018-11-16")))) == "2018-11-16T00:00:00.000Z"


def test_compact_stamp(spark):
    moment = F.lit("2018-11-16 20:30:05").cast("timestamp")
    assert value(spark, scalars.compact_stamp(moment)) == "20181116203005"


def test_once_is_evaluated_in_a_single_place(spark, capsys):
    lines = spark.createDataFrame([("1,2",), ("x",)], "value string")
    record = scalars.once(F.from_csv("value", "a int, b int")).alias("r")
    wanted = lines.select(record).where("r.a is not null and r.b > r.a")
    assert [tuple(r.r) for r in wanted.collect()] == [(1, 2)]
    wanted.explain("simple")
    assert capsys.readouterr().out.count("from_csv(") == 1
