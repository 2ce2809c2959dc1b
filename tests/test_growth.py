"""What must not grow with the rows: files, batches, and shuffles of whole tables."""

import datetime as dt
import json
import os
from collections import Counter

import pytest

from eventfares.plans import queries
from eventfares.sources import pages, sinks
from eventfares.streaming import averages, combine, join, run

from .conftest import day

N_EVENTS = 40


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Small tables of their own: concerts on 60 days in 3 cities, a fare for each, 40 conversations."""
    base = str(tmp_path_factory.mktemp("tables"))
    first = dt.datetime(1999, 1, 1)
    rows = {
        "region": ("r_regionkey int, r_name string", [(0, "EUROPE")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(k, f"NATION_{k}", 0) for k in range(3)]),
        "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(k, f"C{k}", k, 1.0, "BUILDING") for k in range(3)]),
        "supplier": ("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double", [(k, f"S{k}", k, 1.0) for k in range(3)]),
        "orders": (
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
            [(i, i % 3, "F", 10.0, first + dt.timedelta(days=i // 3), "1-URGENT") for i in range(180)],
        ),
        "lineitem": (
            "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, l_shipdate timestamp",
            [(i, i % 3, 1, 1.0 + i, first + dt.timedelta(days=i // 3)) for i in range(180)],
        ),
        "conversations": ("conv_id bigint, turn bigint, role string, text string", [(i, t, "user", "A. B") for i in range(N_EVENTS) for t in range(2)]),
    }
    for name, (schema, values) in rows.items():
        folder = f"{base}/.{name}"
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(folder)
        (part,) = [f for f in os.listdir(folder) if f.endswith(".parquet")]
        os.link(f"{folder}/{part}", f"{base}/{name}.parquet")  # a stream reads files of that name
    return base


@pytest.fixture
def made(monkeypatch):
    """The paths that queries have made, by label."""
    paths = {}
    new_path = queries.new_path

    def noted(spark, label):
        paths[label] = new_path(spark, label)
        return paths[label]

    monkeypatch.setattr(queries, "new_path", noted)
    return paths


def test_records_say_the_event_of_a_setlist_page(spark, tmp_path):
    def page(*ids):
        return json.dumps({"resultsPage": {"results": {"setlist": [{"id": i, "setlistItem": []} for i in ids]}}})

    lines = [json.dumps({"event_id": 7, "body": page(1, 2)}), json.dumps({"body": page(3)}), json.dumps({"event_id": 8, "body": "{"}), page(4), "junk"]
    (tmp_path / "pages.json").write_text("\n".join(lines))
    good, bad = pages.read_setlist_pages(spark, str(tmp_path), request="event_id bigint")
    assert sorted((r.id, r.event_id) for r in good.collect()) == [(1, 7), (2, 7), (3, None), (4, None)]
    found = sorted((r.event_id or 0, r.body, r.reason) for r in bad.collect())
    assert found == [(0, "junk", "malformed"), (8, "{", "malformed")]


def test_setlist_pages_are_no_file_for_each_event(spark, tables, made):
    rows = {(r.kind, r.reason): (r.n, r.ids) for r in queries.page_items(spark, tables).collect()}
    assert rows["setlist", "none"] == (52, 26) and rows["setlist", "bad setlist"] == (28, 14)
    files = [f for _, _, names in os.walk(made["setlist-pages"]) for f in names if f.startswith("part-")]
    assert 0 < len(files) < N_EVENTS / 2


def test_batches_of_documents_do_not_grow_with_partitions(spark, tables, made):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    try:
        documents = {(r.event_city, r.event_date[:10]): r.avg_price for r in queries.documents_current(spark, tables).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    batches = sinks.folders(spark, f"{made['stream-current']}/documents", "batch")
    assert 4 <= len(batches) <= queries.DOCUMENT_BATCHES
    assert sinks.folders(spark, f"{made['stream-current']}/documents-current", "version")
    # Feeds meet within 30 days counted from 1970-01-01, which begin anew on 1999-01-29 and 1999-02-28.
    assert documents["NATION_1", "1999-01-02"] == 2.0 and ("NATION_1", "1999-01-29") not in documents
    assert len(documents) == 3 * (60 - 3)


@pytest.mark.parametrize("listed", [1_000, 7])
def test_join_state_is_no_row_for_each_fare(spark, tmp_path, monkeypatch, listed):
    monkeypatch.setattr(combine, "LISTED_ROWS", listed)
    at, n = dt.datetime(2020, 1, 1, 12), 300
    concerts = [(day(d), "Rome", at) for d in ("2020-02-02", "2020-02-02", "2020-02-04")] + [(day("2020-02-02"), None, at)]
    fares = [("Rome", day(d), p, at) for d in ("2020-02-01", "2020-02-03") for p in range(n)]
    fares += [("Rome", day("2020-02-01"), 5, at), ("Rome", day("2020-02-01"), None, at), ("Rome", None, 1, at), (None, day("2020-02-01"), 1, at)]
    spark.createDataFrame(concerts, "event_date date, event_city string, arrival timestamp").write.parquet(f"{tmp_path}/concerts")
    spark.createDataFrame(fares, "end_city string, flight_date date, price bigint, arrival timestamp").write.parquet(f"{tmp_path}/fares")
    both = [spark.readStream.schema(spark.read.parquet(p).schema).parquet(p) for p in (f"{tmp_path}/concerts", f"{tmp_path}/fares")]
    matches = join.join_feeds(*both, interval="1 day", delay="1 day", salts=2).select("event_date", "price", "weight")
    query = run.start(join.write_matches(matches, f"{tmp_path}/matches"), f"{tmp_path}/checkpoint", once=True)
    query.awaitTermination()
    found = Counter((str(r.event_date), r.price, r.weight) for r in spark.read.parquet(f"{tmp_path}/matches").collect())
    # The fares of the 1st serve both dates, those of the 3rd the 4th alone.
    wanted = Counter(("2020-02-02", p, 4 if p == 5 else 2) for p in [*range(n), None])
    wanted += Counter(("2020-02-04", p, 2 if p == 5 else 1) for p in [*range(n), None]) + Counter(("2020-02-04", p, 1) for p in range(n))
    assert found == wanted
    rows = max(operator["numRowsTotal"] for progress in query.recentProgress for operator in progress["stateOperators"])
    assert rows < 2 * n / 3


def test_running_averages_need_no_join_of_all_records(spark):
    schema = "event_city string, event_date date, part bigint, "
    placed = spark.createDataFrame([("Rome", None, 1, 7, 1, 4), (None, None, 1, None, 0, 5), ("Rome", None, 1, 8, 1, 3)], schema + "total bigint, n bigint, place bigint")
    offsets = spark.createDataFrame([("Rome", None, 1, 10, 2), (None, None, 1, None, None)], schema + "total_before bigint, n_before bigint")
    rows = averages._averages(placed, offsets, 1.0)
    assert "Join" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert Counter((r.event_city, r.avg_price, r.n) for r in rows.collect()) == Counter([("Rome", 6.0, 3), ("Rome", 6.25, 4), (None, None, 0)])
