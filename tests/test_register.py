"""Every registered query against its SQL in DuckDB, on the smallest test tables."""

import os
from pathlib import Path

import pytest

import __spark_entry__ as driver
from tests.compare import differences, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


#: Of the loads and their operators; tests/llm has the others.
OWN = sorted(name for name in driver.queries() if name.startswith("q_"))


def test_every_query_has_its_sql():
    assert set(OWN) <= driver.oracle_sql().keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    found = driver.queries()[name](spark, SF_DIR)
    assert differences(found, con, driver.oracle_sql()[name]) == []


def test_entry(spark):
    assert len(driver.entry(spark).columns) == 86


def test_fact_and_pivots_hold_every_line(spark, con):
    """The cells of the wide results add up to the totals of the table."""
    quantity, suppliers = con.execute("select sum(cast(l_quantity as int)), sum(l_suppkey) from lineitem").fetchone()
    kept = con.execute(f"select id from ({driver.oracle_sql()['q_fact']}) f").fetchall()
    in_fact = con.execute(
        "select sum(cast(l_quantity as int)) from lineitem where l_orderkey in (select unnest(?))", [[k for (k,) in kept]]
    ).fetchone()[0]

    def total(name, columns):
        found = driver.queries()[name](spark, SF_DIR)
        cells = [c for c in found.columns if columns(c)]
        row = found.selectExpr(*[f"sum(`{c}`) as `{c}`" for c in cells]).first()
        return sum(v or 0 for v in row)

    assert 0 < total("q_fact", lambda c: c.startswith("time_")) == in_fact <= quantity
    assert total("q_pivot_zone", lambda c: c.startswith("l_suppkey_")) == suppliers
    assert total("q_pivot_builtin", lambda c: c != "l_orderkey") == suppliers
