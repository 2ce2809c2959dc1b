import pytest
from pyspark.sql import functions as F

from eventfares.operators import fares

from .conftest import day

D1, D2, D3 = "2018-11-12", "2018-11-13", "2018-11-14"


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_positive_drops_missing_flights(make_flights):
    flights = make_flights(("P", "D", D1, 0), ("P", "D", D2, 5), ("P", "D", D3, -1))
    assert rows(fares.positive(flights), "price") == [(5.0,)]


def test_routes_are_flown_and_lead_elsewhere(make_flights):
    flights = make_flights(("P", "D", D1, 1), ("P", "D", D2, 1), ("D", "P", D1, 1), ("D", "D", D1, 1))
    assert rows(fares.routes(flights), "start_city", "end_city") == [("D", "P"), ("P", "D")]


def test_served_routes(make_flights, spark):
    flights = make_flights(("P", "D", D1, 1), ("P", "R", D1, 2), ("D", "P", D1, 3))
    served = spark.createDataFrame([("P", "D"), ("P", "D"), ("D", "P")], "start_city string, end_city string")
    assert rows(fares.served_routes(flights, served), "price") == [(1.0,), (3.0,)]


def test_date_spine_has_the_leap_day(spark):
    start = spark.createDataFrame([("r", day("2020-02-27"))], "route string, first date")
    spine = fares.date_spine(start, F.col("first"), F.lit(4))
    assert rows(spine, "day_index", "flight_date") == [
        (0, day("2020-02-27")),
        (1, day("2020-02-28")),
        (2, day("2020-02-29")),
        (3, day("2020-03-01")),
    ]


def test_unpivot(spark):
    packed = spark.createDataFrame(
        [("P", "D", day("2019-02-27"), [1.0, 0.0, 3.0]), ("D", "P", day(D1), [])],
        "start_city string, end_city string, first date, prices array<double>",
    )
    long = fares.unpivot(packed, F.col("first"))
    assert rows(long, *fares.CELL, "price") == [
        ("P", "D", day("2019-02-27"), 1.0),
        ("P", "D", day("2019-03-01"), 3.0),
    ]


def test_decode_ids(spark):
    cells = spark.createDataFrame([(0, 1, 5.0)], "i int, j int, price double")
    names = spark.createDataFrame([(0, "P"), (1, "D")], "id int, name string")
    named = fares.decode_ids(fares.decode_ids(cells, names, "i", "start_city"), names, "j", "end_city")
    assert rows(named, "start_city", "end_city", "price") == [("P", "D", 5.0)]


def test_route_range_ignores_missing_flights(make_flights):
    flights = make_flights(("P", "D", D1, 0), ("P", "D", D2, 5), ("P", "D", D3, 9), ("P", "R", D1, 0))
    assert rows(fares.route_range(flights), "end_city", "min_price", "max_price") == [
        ("D", 5.0, 9.0),
        ("R", None, 0.0),
    ]


@pytest.fixture
def bases(spark):
    return spark.createDataFrame(
        [("P", "D", 100.0), ("P", "R", 50.0)], "start_city string, end_city string, base double"
    )


def test_rescale_maps_existing_fares_onto_the_base_range(make_flights, bases):
    flights = make_flights(
        ("P", "D", D1, 1), ("P", "D", D2, 2), ("P", "D", D3, 5), ("P", "D", "2018-12-01", 0), ("P", "R", D1, 7)
    )
    scaled = fares.rescale(flights, bases)
    assert [r.scaled_price for r in scaled.orderBy("end_city", "flight_date").collect()] == [
        100.0, 125.0, 200.0, 0.0, None,
    ]


def test_cap_and_over_cap(make_flights, bases):
    flights = make_flights(("P", "D", D1, 150), ("P", "D", D2, 200), ("P", "D", D3, 201))
    assert rows(fares.over_cap(flights, bases), "price") == [(201.0,)]
    assert rows(fares.cap(flights, bases), "capped_price") == [(150.0,), (200.0,), (200.0,)]


def test_fares_without_a_base_survive(make_flights, bases):
    flights = make_flights(("P", "D", D1, 150), ("X", "Y", D1, 9), ("X", "Y", D2, 10))
    assert rows(fares.cap(flights, bases), "start_city", "capped_price") == [("P", 150.0), ("X", 9.0), ("X", 10.0)]
    assert [r.scaled_price for r in fares.rescale(flights, bases).where("start_city = 'X'").collect()] == [None, None]
    assert rows(fares.over_cap(flights, bases), "start_city") == []


def test_ids_without_a_name_survive(spark):
    cells = spark.createDataFrame([(0, 5.0), (9, 6.0), (None, 7.0)], "i int, price double")
    names = spark.createDataFrame([(0, "P")], "id int, name string")
    named = fares.decode_ids(cells, names, "i", "city")
    assert sorted((r.price, r.city) for r in named.collect()) == [(5.0, "P"), (6.0, None), (7.0, None)]


@pytest.mark.parametrize("days", [0, 1])
def test_short_horizons(spark, days):
    start = spark.createDataFrame([("r", day(D1))], "route string, first date")
    assert fares.date_spine(start, F.col("first"), F.lit(days)).count() == days


def test_of_fares_that_arrived_together_the_highest_counts(make_flights):
    flights = make_flights(("P", "D", D1, 3), ("P", "D", D1, 8), ("P", "D", D1, 5)).withColumn("arrival", F.lit(1))
    assert rows(fares.latest(flights, "arrival"), "price") == [(8.0,)]


def test_diff_shows_changed_new_and_dropped_cells(make_flights):
    old = make_flights(("P", "D", D1, 1), ("P", "D", D2, 2), ("P", "D", D3, 3))
    new = make_flights(("P", "D", D1, 1), ("P", "D", D2, 9), ("P", "R", D1, 4))
    changed = fares.diff(old, new).collect()
    assert sorted([(r.end_city, r.flight_date, r.old_price, r.new_price) for r in changed], key=str) == [
        ("D", day(D2), 2.0, 9.0),
        ("D", day(D3), 3.0, None),
        ("R", day(D1), None, 4.0),
    ]


def test_latest_overlays_earlier_snapshots(make_flights):
    first = make_flights(("P", "D", D1, 1), ("P", "D", D2, 2)).withColumn("arrival", F.lit(1))
    second = make_flights(("P", "D", D2, 7)).withColumn("arrival", F.lit(2))
    latest = fares.latest(first.unionByName(second), "arrival")
    assert rows(latest, "flight_date", "price", "arrival") == [(day(D1), 1.0, 1), (day(D2), 7.0, 2)]
