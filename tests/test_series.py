"""Validity of fares over a series of snapshots, and pages that did not come."""

import json
import random
from itertools import groupby

from eventfares.operators import fares
from eventfares.sources import pages


def test_validity_against_walking_the_series(spark):
    pick = random.Random(1)
    cells = [("Paris", city, f"2018-11-{d:02}") for city in ("Dublin", "Rome") for d in range(1, 6)] + [(None, "Rome", "2018-11-01")]
    times, rows, expected = [3, 5, 6, 9, 12, 20], [], []
    for cell in cells:
        series = [pick.choice([None, 10, 10, 20]) for _ in times]
        rows += [(*cell, price, t) for price, t in zip(series, times) if price is not None]
        for price, run in groupby(zip(times, series), key=lambda x: x[1]):
            seen = [t for t, _ in run]
            if price is not None:
                expected.append((*cell, price, seen[0], seen[-1], len(seen)))
    rows += [("Paris", "Oslo", "2018-11-01", 7, 3), ("Paris", "Oslo", "2018-11-01", 9, 3)]  # twice in a snapshot
    expected.append(("Paris", "Oslo", "2018-11-01", 9, 3, 3, 1))
    history = spark.createDataFrame([(*r, "x") for r in rows], "start_city string, end_city string, flight_date string, price int, arrival int, other string")
    found = fares.validity(history)
    assert found.columns == [*fares.CELL, "price", "first_seen", "last_seen", "n_snapshots"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    assert fares.validity(history.where("false")).count() == 0


def body(page, per_page, total):
    return json.dumps({"resultsPage": {"page": page, "perPage": per_page, "totalEntries": total, "results": {}}})


def missing(spark, rows):
    read = spark.createDataFrame(rows, "request string, body string")
    return sorted(map(tuple, pages.missing_pages(pages.page_numbers(read), "request").collect()), key=str)


def test_missing_pages(spark):
    rows = [("whole", body(p, 50, 120)) for p in (1, 2, 3)]
    rows += [("holes", body(p, 10, 95)) for p in (2, 5, 5, 6)]
    rows += [("none", body(1, 50, 0)), ("first", body(1, 50, 51)), (None, body(2, 50, 100))]
    rows += [("unsaid", "{}"), ("unsaid", "broken"), ("text", body("x", "y", "z"))]
    assert missing(spark, rows) == sorted(
        [("holes", 1, 1, 10), ("holes", 3, 4, 20), ("holes", 7, 10, 35), ("first", 2, 2, 1), (None, 1, 1, 50)], key=str
    )


def test_a_total_that_grows_while_pages_are_read(spark):
    rows = [("r", body(1, 10, 19)), ("r", body(2, 10, 31))]
    assert missing(spark, rows) == [("r", 3, 4, 11)]


def test_no_pages(spark):
    assert missing(spark, []) == []
