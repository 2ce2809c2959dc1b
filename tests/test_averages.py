"""The joins and the average, against plain Python and against each other."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventfares.functions.scalars import in_window
from eventfares.operators.aggs import event_fare_avg
from eventfares.operators.joins import city_totals, event_flights_window, fares_by_event_date

from .conftest import CONCERTS, FLIGHTS, day


def all_pairs(concerts, flights):
    """The plain join on city, for small inputs."""
    return concerts.join(flights, concerts["event_city"] == flights["end_city"])


def naive(concerts, flights):
    """(city, date) -> [prices] by nested loops."""
    found = {}
    for _, date, city in concerts:
        for _, end, flown, price in flights:
            if city == end and dt.timedelta(1) <= day(date) - day(flown) <= dt.timedelta(4):
                found.setdefault((city, day(date)), []).append(price)
    return found


def averages(df):
    return {(r.event_city, r.event_date): (r.avg_price, r.n) for r in df.collect()}


EDGES = [("P", "Dublin", d, p) for d, p in
         (("2018-11-11", 1), ("2018-11-12", 10), ("2018-11-15", 30), ("2018-11-16", 100))]


def test_window_edges(make_concerts, make_flights):
    concerts, flights = make_concerts((1, "2018-11-16", "Dublin")), make_flights(*EDGES)
    joined = event_flights_window(concerts, flights)
    assert sorted(r.price for r in joined.collect()) == [10.0, 30.0]
    assert averages(event_fare_avg(concerts, flights)) == {("Dublin", day("2018-11-16")): (20.0, 2)}


def test_two_concerts_on_one_key_count_each_fare_twice(make_concerts, make_flights):
    concerts = make_concerts((1, "2018-11-16", "Dublin"), (2, "2018-11-16", "Dublin"))
    flights = make_flights(*EDGES)
    assert event_flights_window(concerts, flights).count() == 4
    assert averages(event_fare_avg(concerts, flights)) == {("Dublin", day("2018-11-16")): (20.0, 4)}


@pytest.mark.parametrize("days", [0, 1])
def test_short_windows(make_concerts, make_flights, days):
    concerts = make_concerts((1, "2018-11-16", "Dublin"), (2, "2018-11-16", "Dublin"))
    flights = make_flights(*[("P", "Dublin", f"2018-11-{d}", 10) for d in (14, 15, 16, 17)])
    assert [r.n for r in event_fare_avg(concerts, flights, days=days).collect()] == [2] * days
    assert event_flights_window(concerts, flights, days=days).count() == 2 * days
    weighted = fares_by_event_date(concerts, flights, days=days).collect()
    assert [(r.n_concerts, r.flight_date) for r in weighted] == [(2, day("2018-11-15"))] * days


def test_keys_without_a_match_are_absent(make_concerts, make_flights):
    concerts = make_concerts((1, "2018-11-16", "Rome"), (2, "2019-11-16", "Dublin"))
    assert averages(event_fare_avg(concerts, make_flights(*EDGES))) == {}


def test_unit_divides_cents(make_concerts, make_flights):
    concerts = make_concerts((1, "2018-11-16", "Dublin"))
    flights = make_flights(*EDGES).withColumn("cents", F.col("price").cast("long"))
    avg = averages(event_fare_avg(concerts, flights, "cents", 100.0))
    assert avg == {("Dublin", day("2018-11-16")): (0.2, 2)}


def _some(seed, n):
    pick = random.Random(seed)
    date = lambda: str(dt.date(2018, 11, 1) + dt.timedelta(pick.randrange(12)))
    # A third of everything is in one city on one date.
    hot = lambda: pick.random() < 1 / 3
    concerts = [
        (i, "2018-11-06", "Rome") if hot() else (i, date(), pick.choice("ABC")) for i in range(n)
    ]
    flights = [
        ("P", "Rome", "2018-11-05", 7) if hot() else ("P", pick.choice("ABC"), date(), pick.randrange(1, 99))
        for _ in range(3 * n)
    ]
    return concerts, flights


def test_all_forms_agree_with_nested_loops(make_concerts, make_flights):
    concerts, flights = _some(seed=1, n=60)
    expected = naive(concerts, flights)
    c, f = make_concerts(*concerts), make_flights(*flights)
    averaged = averages(event_fare_avg(c, f))
    assert averaged == {k: (sum(v) / len(v), len(v)) for k, v in expected.items()}

    ranged = all_pairs(c, f).where(in_window(F.col("flight_date"), F.col("event_date")))
    for joined in (event_flights_window(c, f), ranged):
        pairs = sorted((r.event_city, r.event_date, r.price) for r in joined.collect())
        assert pairs == sorted((*k, p) for k, v in expected.items() for p in v)


def test_totals_equal_the_unfiltered_join(make_concerts, make_flights):
    concerts, flights = _some(seed=2, n=40)
    c, f = make_concerts(*concerts), make_flights(*flights)
    joined = all_pairs(c, f).groupBy("event_city").agg(F.count("*"), F.avg("price")).collect()
    totals = city_totals(c, f).collect()
    assert sorted((r.event_city, r.pairs, round(r.avg_price, 9)) for r in totals) == sorted(
        (city, float(n), round(mean, 9)) for city, n, mean in joined
    )


cities = st.sampled_from(["Rome", "Dublin"])
dates = st.dates(dt.date(2020, 2, 25), dt.date(2020, 3, 5)).map(str)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 9), dates, cities), max_size=8),
    st.lists(st.tuples(st.just("P"), cities, dates, st.integers(1, 9)), max_size=12),
)
def test_average_property(spark, concerts, flights):
    c = spark.createDataFrame([(i, "A", day(d), city) for i, d, city in concerts], CONCERTS)
    f = spark.createDataFrame([(s, e, day(d), float(p)) for s, e, d, p in flights], FLIGHTS)
    expected = {k: (sum(v) / len(v), len(v)) for k, v in naive(concerts, flights).items()}
    assert averages(event_fare_avg(c, f)) == expected


def test_shuffles_follow_a_partial_aggregation(make_concerts, make_flights, capsys):
    event_fare_avg(make_concerts((1, "2018-11-16", "Dublin")), make_flights(*EDGES)).explain("simple")
    plan = capsys.readouterr().out.splitlines()
    shuffles = [i for i, line in enumerate(plan) if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 3
    assert all("partial_" in plan[i + 1] for i in shuffles)
    assert not any("Nested" in line or "Cartesian" in line for line in plan)


def test_a_hot_key_is_split_by_the_adaptive_join(spark, make_concerts, make_flights):
    """With thresholds scaled down to the fixture, the hot (city, date) is spread over tasks."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200B",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "300B",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        # The hot rows are exact copies, which no hash could tell apart.
        fares = [("P", "Rome", "2018-11-05", 7)] * 4000 + [("P", c, "2018-11-05", 1) for c in "ABCDEF"]
        flights = make_flights(*fares).repartition(8)
        concerts = make_concerts((1, "2018-11-06", "Rome"), *[(2, "2018-11-06", c) for c in "ABCDEF"])
        joined = event_flights_window(concerts, flights)
        assert len(joined.collect()) == 4006
        assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
