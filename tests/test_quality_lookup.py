import pytest
from helpers import T, plan, rows
from pyspark.sql import functions as F

from tiermart.operators.lookup import as_of
from tiermart.operators.quality import (
    assign_surrogate_key,
    check_entity,
    check_foreign_key,
    check_not_null,
    check_unique,
    orphan_rows,
    require_not_null,
)
from tiermart.schemas import ENTITIES


def test_not_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert rows(check_not_null(df, ["a", "b"])) == [("a", 1), ("b", 2)]


def test_unique(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(check_unique(df, ["k"])) == [(1, 2)]


def test_foreign_key(spark):
    child = spark.createDataFrame([(1, 7), (2, 8), (3, 8), (4, None)], "id int, fk int")
    parent = spark.createDataFrame([(7,)], "k int")
    assert rows(check_foreign_key(child, parent, ["fk"], ["k"])) == [(8, 2)]
    assert rows(orphan_rows(child, parent, ["fk"], ["k"])) == [(2, 8), (3, 8)]


def test_required_column_aborts(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    assert rows(require_not_null(df, ["v"])) == rows(df)
    with pytest.raises(Exception, match="NULL in required column k"):
        require_not_null(df, ["k"]).collect()


def test_checks_of_an_entity(spark):
    entity = ENTITIES["orders"]
    orders = spark.createDataFrame(
        [(1, 5, None, "Shipped", None, 1), (1, 6, None, "Shipped", None, 1)],
        "order_id long, customer_id long, order_date date, order_status string, "
        "total_value decimal(10,2), address_id long",
    )
    customers = spark.createDataFrame([(5,)], "customer_id long")
    checks = check_entity(orders, entity, {"customers": customers})
    assert rows(checks["unique"]) == [(1, 2)]
    assert rows(checks["not_null"]) == [("order_date", 2), ("total_value", 2)]
    assert rows(checks["foreign_key_customers"]) == [(6, 1)]


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_surrogate_keys_are_gapless_and_ordered(spark, conf, partitions):
    conf(shuffle__partitions=partitions)
    ids = [-9, -8, 0, 3, 3, 7, 700, 50_000, None, None]
    values = list(zip(ids, "abcdfghikl"))
    df = spark.createDataFrame(list(reversed(values)), "id long, name string").repartition(3)
    keyed = assign_surrogate_key(df, "sk", "id", start=100)
    assert rows(keyed) == [(100 + n, *row) for n, row in enumerate(values)]


def test_surrogate_keys_of_equal_rows_and_of_none(spark):
    df = spark.createDataFrame([(None, {"a": 1})] * 500, "id string, m map<string,int>")
    keyed = assign_surrogate_key(df, "sk", "id")
    assert sorted(r.sk for r in keyed.collect()) == list(range(1, 501))
    assert assign_surrogate_key(df.limit(0), "sk", "id").collect() == []


def test_as_of_takes_the_version_valid_at_the_time(spark):
    dim = spark.createDataFrame(
        [(1, "a", T[0], T[2]), (1, "b", T[2], None), (2, "c", T[1], None)],
        "k int, v string, effective_start_date timestamp_ntz, effective_end_date timestamp_ntz",
    )
    facts = spark.createDataFrame(
        [(1, T[1]), (1, T[2]), (2, T[0]), (2, T[5]), (3, T[1])], "k int, at timestamp_ntz"
    )
    found = as_of(facts, dim, ["k"], "at", ["v"])
    assert rows(found) == sorted(
        [(1, T[1], "a"), (1, T[2], "b"), (2, T[0], None), (2, T[5], "c"), (3, T[1], None)], key=repr
    )
    assert as_of(facts, dim, ["k"], "at", ["v"], how="inner").count() == 3


def test_hot_foreign_key_is_reduced_before_the_join(spark):
    child = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("fk")
    )
    parent = spark.range(30_000).select(F.col("id").alias("k"))
    assert rows(check_foreign_key(child, parent, ["fk"], ["k"])) == [(-1, 10_000)]


def test_hot_orphans_are_divided_and_all_found(spark):
    child = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("fk"), "id"
    )
    parent = spark.range(30_000).select(F.col("id").alias("k")).union(spark.range(10))
    orphans = orphan_rows(child, parent, ["fk"], ["k"])
    assert "__cell" in plan(orphans, "simple")
    assert orphans.columns == ["fk", "id"]
    assert orphans.count() == 10_000 and orphans.select("id").distinct().count() == 10_000


def test_keys_of_different_types(spark):
    child = spark.createDataFrame([(1,), (2,)], "fk int")
    parent = spark.createDataFrame([(1,), (2**40,)], "k long")
    assert rows(orphan_rows(child, parent, ["fk"], ["k"])) == [(2,)]
    assert rows(check_foreign_key(child, parent, ["fk"], ["k"])) == [(2, 1)]
