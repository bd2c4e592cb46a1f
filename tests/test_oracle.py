"""Every registered query against its DuckDB SQL."""

import pytest

import __spark_entry__ as contract
import compare
from compare import SMALL
from workload import analysis
from workload.queries import all_queries

QUERIES = {name: contract.queries()[name] for name in all_queries() | analysis.all_queries()}
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con():
    return compare.connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert len(all_queries()) == 68


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, name):
    assert compare.differences(QUERIES[name](spark, SMALL), con, SQL[name]) == []


def test_entry_ranks_zones(spark):
    rows = contract.entry(spark).collect()
    assert [row.demand_rank for row in rows] == sorted(row.demand_rank for row in rows)
    assert rows and rows[0].demand_rank == 1
