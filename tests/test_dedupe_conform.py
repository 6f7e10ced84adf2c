import datetime as dt
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermart.functions import convert_timezone, exact_mean, growth_percentage
from tiermart.operators.conform import conform, conform_entity, conform_or_quarantine
from tiermart.operators.dedupe import dedupe_latest
from tiermart.schemas import ENTITIES


def _kt(spark, data):
    return spark.createDataFrame(data, "k int, t int, v string")


def test_latest_row_wins(spark):
    df = _kt(spark, [(1, 10, "a"), (1, 20, "b"), (2, 5, "c")])
    assert rows(dedupe_latest(df, ["k"], ["t"])) == [(1, 20, "b"), (2, 5, "c")]


@pytest.mark.parametrize("data", [["a", "b"], ["b", "a"]])
def test_ties_do_not_depend_on_input_order(spark, data):
    df = _kt(spark, [(1, 10, v) for v in data])
    assert rows(dedupe_latest(df, ["k"], ["t"])) == [(1, 10, "b")]


def test_null_times_lose(spark):
    df = _kt(spark, [(1, None, "a"), (1, 1, "b")])
    assert rows(dedupe_latest(df, ["k"], ["t"])) == [(1, 1, "b")]


def test_null_keys(spark):
    df = _kt(spark, [(None, 10, "a"), (None, 20, "b")])
    assert rows(dedupe_latest(df, ["k"], ["t"])) == [(None, 20, "b")]
    assert rows(dedupe_latest(df, ["k"], ["t"], drop_null_keys=True)) == []


def test_custom_order(spark):
    df = _kt(spark, [(1, 10, "a"), (1, 20, "b")])
    assert rows(dedupe_latest(df, ["k"], [F.asc("t")])) == [(1, 10, "a")]


def test_conform_types_and_derived_column(spark):
    entity = ENTITIES["order_items"]
    df = spark.createDataFrame([("1", "2", "3", "2", "9.995")], entity.source_schema)
    typed = conform_entity(df, entity)
    assert rows(typed) == [(1, 2, 3, Decimal("2.00"), Decimal("10.00"), Decimal("20.00"))]
    assert typed.schema["total_value"].dataType == T.DecimalType(10, 2)


@pytest.mark.parametrize(
    "value, kind", [("x", "date"), ("12a", "bigint"), ("123456789.00", "decimal(10,2)")]
)
def test_value_that_does_not_fit_aborts(spark, value, kind):
    df = spark.createDataFrame([(value,)], "c string")
    fields = [("c", T._parse_datatype_string(kind))]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|NUMERIC_VALUE_OUT_OF_RANGE"):
        conform(df, fields).collect()
    good, bad = conform_or_quarantine(df, fields)
    assert rows(good) == [] and rows(bad) == [(value, ["c"])]


def test_quarantine_keeps_nulls_and_names_every_column(spark):
    df = spark.createDataFrame([("1", None), ("x", "y"), ("2", "2024-01-01")], "a string, b string")
    good, bad = conform_or_quarantine(df, [("a", T.LongType()), ("b", T.DateType())])
    assert rows(good) == [(1, None), (2, dt.date(2024, 1, 1))]
    assert rows(bad) == [("x", "y", ["a", "b"])]


def test_phone_numbers_stay_text(spark):
    entity = ENTITIES["delivery_partners"]
    df = spark.createDataFrame([("1", "P", "0655", "South")], entity.source_schema)
    assert rows(conform_entity(df, entity)) == [(1, "P", "0655", "South")]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_zone_shift_does_not_depend_on_the_session(spark, conf, zone):
    conf(session__timeZone=zone)
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 20:00:00' AS t")
    shifted = df.select(convert_timezone(F.col("t")).cast("string"))
    assert rows(shifted) == [("2024-01-02 01:30:00",)]


def test_mean_rounds_half_up_in_decimals(spark):
    df = spark.createDataFrame([(Decimal("0.01"),), (Decimal("0.02"),)], "v decimal(10,2)")
    mean = df.agg(exact_mean(F.sum("v"), F.count("v"))).first()[0]
    assert mean == Decimal("0.02")
    empty = df.filter("false").agg(exact_mean(F.sum("v"), F.count("v"))).first()[0]
    assert empty is None


def test_growth_without_or_with_zero_base(spark):
    df = spark.createDataFrame(
        [(1, None), (1, Decimal(0)), (3, Decimal(2))], "id int, p decimal(10,2)"
    )
    growth = growth_percentage(F.col("id").cast("decimal(10,2)"), F.col("p"))
    assert rows(df.select(growth)) == [(50.0,), (None,), (None,)]
