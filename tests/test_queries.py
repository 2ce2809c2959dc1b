"""Every registered query against its SQL, on whole tables."""


import pytest

import __spark_entry__ as entry_points

from eventfares.plans.oracle import ORACLE
from eventfares.plans.queries import QUERIES as OWN

from . import compare
from .conftest import SF_DIR

QUERIES = {name: query for name, query in entry_points.queries().items() if name in OWN}


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE) == set(OWN)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_gives_what_its_sql_gives(spark, connection, name):
    rows, ours, theirs = compare.differences(QUERIES[name](spark, SF_DIR), connection, ORACLE[name])
    assert rows > 0
    assert not ours and not theirs, (ours[:3], theirs[:3])


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["event_city", "event_date", "avg_price", "n"]


def test_every_fare_has_an_origin(spark, connection):
    """What allows a question about destinations to leave the orders out."""
    orphans = "SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"
    assert connection.sql(orphans).fetchall() == [(0,)]
