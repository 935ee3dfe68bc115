"""Every registered query against its DuckDB oracle on the sf0.001 tables (the
driver runs the same comparison at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import check, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
from rillet.plans.oracle_sql import SQL  # noqa: E402
from rillet.plans.registry import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(SQL)


def test_the_entry_registers_every_query():
    """The optional subpackage adds queries of its own names and takes none away."""
    assert {n: q for n, q in entry.queries().items() if n in QUERIES} == QUERIES
    assert {n: q for n, q in entry.oracle_sql().items() if n in SQL} == SQL
    assert all(n == "pipeline" or n.startswith("op") for n in set(entry.queries()) - set(QUERIES))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = check(spark, con, name, QUERIES[name], SQL.get(name), SF)
    assert res["ok"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["dt", "hr", "dau_td", "dau_yd", "dau_total"]
    assert df.count() > 0
