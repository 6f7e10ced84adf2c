"""Exact distinct counts from mergeable bitmaps."""

import random

from helpers import plan, rows
from pyspark.sql import functions as F

from tiermart.operators.bitmaps import distinct_counts, distinct_state, merge_states
from tiermart.plans import analytics

SCHEMA = "g string, id long, v long"


def _data(n):
    draw = random.Random(4)
    ids = [None, 0, 1, -1, 32_767, 32_768, 32_769, -32_768, -32_769, 2**62, -(2**63), 2**63 - 1, *range(100, 160)]
    return [(draw.choice(["a", "b", None]), draw.choice(ids), i) for i in range(n)] + [("none", None, 5)]


def test_counts_are_exact_and_states_merge(spark):
    data = _data(3000)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    want = rows(df.groupBy("g").agg(F.count_distinct("id").alias("n"), F.sum("v").alias("v")))
    whole = distinct_state(df, ["g"], "id", {"v": F.col("v")})
    assert rows(distinct_counts(whole, ["g"], "n", ["v"])) == want
    loads = [distinct_state(spark.createDataFrame(data[i::3], SCHEMA), ["g"], "id", {"v": F.col("v")}) for i in range(3)]
    merged = merge_states(loads, ["g"], ["v"])
    assert rows(distinct_counts(merged, ["g"], "n", ["v"])) == want
    again = merge_states([merged, loads[0]], ["g"], ["v"])  # ids count once, sums twice
    assert rows(distinct_counts(again, ["g"], "n")) == [w[:2] for w in want]


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert rows(distinct_counts(distinct_state(none, [], "id"), [], "n")) == [(0,)]
    assert rows(distinct_counts(distinct_state(none, ["g"], "id"), ["g"], "n")) == []


def test_reports_have_no_expand(spark):
    master = spark.createDataFrame(
        [(1, 1, "Delivered", "Pune", "Female", 5)],
        "order_id long, customer_id long, order_status string, customer_city string, gender string, total_value int",
    )
    for report in (
        analytics.unique_customers_by_bitmap(master),
        analytics.customers_and_sales_by_bitmap(master, "gender"),
        analytics.sales_conversion_rate_by_bitmap(master),
    ):
        assert "Expand" not in plan(report) and report.count() == 1
