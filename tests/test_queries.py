"""Every registered query against its SQL counterpart in another engine."""

import os

import pytest

import __spark_entry__ as entry
import check
from tiermart.plans.registry import all_queries

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the benchmark tables")


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(all_queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, con, name):
    got = entry.queries()[name](spark, SF_DIR).toArrow()
    assert got.num_rows > 0
    expected = con.sql(entry.oracle_sql()[name]).to_arrow_table()
    assert check.difference(got, expected) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "month", "year", "monthly_sales", "previous_month_sales", "sales_growth_percentage",
    ]
    assert df.count() > 0
