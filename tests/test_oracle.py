"""Every registered query runs; those with a SQL twin give its result on the smallest tables."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as entry_point
from tripweave.plans import catalog, network

LARGER = "/root/testdata/sf0.01"
QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()


# ten docks make a network without busy pairs, so its queries use the next larger tables
NETWORK = {name for name, item in catalog.entries().items() if item.run.__module__ == network.__name__}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connections = {folder: oracle.connect(folder) for folder in (sf_dir, LARGER)}
    yield connections
    for con in connections.values():
        con.close()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(name, spark, sf_dir, duck):
    folder = LARGER if name in NETWORK else sf_dir
    assert oracle.compare(QUERIES[name](spark, folder), duck[folder], SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(name, spark, sf_dir):
    # some find nothing in the smallest tables
    assert QUERIES[name](spark, sf_dir).take(1) or QUERIES[name](spark, LARGER).take(1)


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["district", "trips", "mean_duration", "revenue"]


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
