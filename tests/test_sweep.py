"""Point-in-time lookups by one order of facts and versions."""

import random

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tiermart.operators.lookup import as_of, as_of_sweep

DIM = "k int, effective_start_date timestamp_ntz, effective_end_date timestamp_ntz, v string, fact string"
FACTS = "k int, n int, at timestamp_ntz, v2 string"


def _day(n):
    return None if n is None else f"TIMESTAMP_NTZ '2024-01-01 00:00:00' + INTERVAL '{n}' HOUR"


def _frame(spark, data, schema, times):
    plain = ", ".join(f"{f.split()[0]} {'int' if f.split()[0] in times else f.split()[1]}" for f in schema.split(", "))
    df = spark.createDataFrame(data, plain)
    start = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")
    return df.withColumns({c: start + F.make_dt_interval(F.lit(0), F.col(c)) for c in times})


def _dim(spark, data):
    return _frame(spark, data, DIM, ["effective_start_date", "effective_end_date"])


def _facts(spark, data):
    return _frame(spark, data, FACTS, ["at"])


def _random(seed, keys, versions, facts):
    draw = random.Random(seed)
    dim = []
    for k in range(keys):
        edges = sorted(draw.sample(range(versions * 4), versions + 1))
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            gap = draw.random() < 0.2 and b - a > 1  # a time without a version
            last = i == versions - 1 and k % 2
            dim.append((k, a, None if last else b - 1 if gap else b, f"{k}.{i}", "f"))
    found = [
        (draw.choice([None, *range(keys + 1)]), i, draw.choice([None, *range(versions * 4 + 2)]), "x")
        for i in range(facts)
    ]
    return dim, found


@pytest.mark.parametrize("partitions, keys, versions", [(1, 5, 6), (7, 3, 40), (16, 1, 60), (16, 30, 3)])
def test_equals_the_join(spark, conf, partitions, keys, versions):
    conf(shuffle__partitions=partitions, adaptive__coalescePartitions__enabled="false")
    dim, facts = _random(keys, keys, versions, 400)
    dim += [(None, 0, None, "none", "f"), (0, None, None, "never", "f"), (0, 1, 1, "empty", "f")]
    d, f = _dim(spark, dim).repartition(3), _facts(spark, facts).repartition(3)
    for how in ("left", "inner"):
        want = as_of(f, d, ["k"], "at", ["v", "fact"], how)
        got = as_of_sweep(f, d, ["k"], "at", ["v", "fact"], how)
        assert got.columns == want.columns and rows(got) == rows(want)


def test_odd_tables(spark):
    d, f = _dim(spark, [(1, 0, None, "a", "f")]), _facts(spark, [(1, 1, 5, "x"), (1, 1, 5, "x")])
    assert rows(as_of_sweep(f, d.limit(0), ["k"], "at", ["v"]).select("v")) == [(None,), (None,)]
    assert rows(as_of_sweep(f, d, ["k"], "at", ["v"]).select("v")) == [("a",), ("a",)]
    assert as_of_sweep(f.limit(0), d, ["k"], "at", ["v"]).collect() == []
    # keys of other types
    text = d.withColumn("k", F.col("k").cast("string")).union(d.withColumn("k", F.lit("one")))
    assert rows(as_of_sweep(f, text, ["k"], "at", ["v"]).select("v")) == [("a",), ("a",)]


def test_a_key_with_many_versions_makes_no_product(spark, conf):
    """10,000 versions and 10,000 facts of one key, over several ranges."""
    conf(shuffle__partitions=8, adaptive__coalescePartitions__enabled="false")
    n = 10_000
    start = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")
    dim = spark.range(n).select(
        F.lit(1).alias("k"),
        (start + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("effective_start_date"),
        (start + F.make_dt_interval(F.lit(0), F.col("id").cast("int") + 1)).alias("effective_end_date"),
        F.col("id").alias("v"),
    )
    facts = spark.range(n).select(
        F.lit(1).alias("k"),
        F.col("id").alias("n"),
        (start + F.make_dt_interval(F.lit(0), F.col("id").cast("int"), F.lit(30))).alias("at"),
    )
    found = as_of_sweep(facts, dim, ["k"], "at", ["v"])
    assert found.where("n = v").count() == n
    # facts meet carried versions only, one row a range
    text = plan(found)
    assert "NestedLoop" not in text and "Cartesian" not in text
