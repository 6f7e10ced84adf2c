"""Checks kept up by loads, against the same checks of the whole tables."""

import random

import pytest
from helpers import rows
from pyspark.sql import types as T

from tiermart.operators.quality import check_entity, check_foreign_key, check_unique
from tiermart.plans.checks import EntityChecks, KeyCounts
from tiermart.schemas import ENTITIES
from tiermart.session import scratch_path
from tiermart.sources.segments import Segments
from tiermart.sources.tables import Layers

SCHEMA = "a long, b string"
KEYS = [T.StructField("a", T.LongType()), T.StructField("b", T.StringType())]


@pytest.fixture
def layers(spark):
    location = scratch_path(spark, "checks")
    made = Layers(spark, "k" + location[-8:] + "_", location)
    made.create()
    yield made
    made.drop_all()


def _draw(n, seed):
    draw = random.Random(seed)
    return [(draw.choice([None, *range(12)]), draw.choice([None, "x", "y"])) for _ in range(n)] + [(5, "x")] * n


def test_loads_and_removals_equal_checks_of_whole_tables(spark, layers):
    kept = KeyCounts(layers, "pairs", KEYS, buckets=8)
    child, parent = [], []
    for load, (more, less, above, gone) in enumerate(
        [(60, 0, 0, 0), (0, 0, 6, 0), (40, 30, 9, 0), (0, 200, 0, 9), (5, 0, 0, 0)], start=1
    ):
        new, removed = _draw(more, load), child[:less]
        new_parents, no_parents = _draw(above, load + 50)[: above + 1], parent[:gone]
        child, parent = child[less:] + new, parent[gone:] + new_parents
        frames = [spark.createDataFrame(part, SCHEMA) for part in (new, removed)]
        frames += [spark.createDataFrame(part, "c long, d string") for part in (new_parents, no_parents)]
        kept.add(load, *frames, parent_columns=["c", "d"])
        whole, parents = (spark.createDataFrame(part, SCHEMA) for part in (child, parent))
        assert rows(kept.repeated()) == rows(check_unique(whole, ["a", "b"]))
        assert rows(kept.orphans()) == rows(check_foreign_key(whole, parents, ["a", "b"]))


def test_a_load_writes_its_buckets_once(spark, layers, monkeypatch):
    kept = KeyCounts(layers, "ids", KEYS[:1], buckets=16)
    many = spark.range(500).toDF("a")
    assert len(kept.add(1, many)) == 16
    versions = kept.held.versions()
    few = spark.createDataFrame([(3,), (3,), (1000,)], "a long")
    touched = kept.held.touched(few)
    assert 0 < len(touched) <= 2

    def fail(*args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Segments, "_publish", fail)
        with pytest.raises(OSError):
            kept.add(2, few)
    assert rows(kept.repeated()) == []
    assert kept.add(2, few) == touched
    assert [b for b in range(16) if kept.held.versions()[b] != versions[b]] == touched
    assert rows(kept.repeated()) == [(3, 3)]
    # a repeated load and an earlier one are in already
    assert kept.add(2, few) == [] and kept.add(1, many) == []
    assert rows(kept.repeated()) == [(3, 3)]


def test_no_rows(spark, layers):
    kept = KeyCounts(layers, "none", KEYS, buckets=2)
    assert rows(kept.orphans()) == [] == rows(kept.repeated())
    assert kept.add(1) == [] and kept.add(1, spark.createDataFrame([], SCHEMA)) == []
    assert rows(kept.counts()) == []


def test_checks_of_an_entity_by_load(spark, layers):
    entity = ENTITIES["orders"]
    schema = "order_id long, customer_id long, order_date date, order_status string, total_value decimal(10,2), address_id long"
    data = [
        [(1, 5, None, "Shipped", None, 1), (2, 6, None, "Shipped", None, 1)],
        [(1, 7, None, None, None, None), (3, None, None, "Shipped", None, 2)],
    ]
    customers = [[(5,)], [(6,)]]
    checks = EntityChecks(layers, entity, buckets=4)
    for load in (1, 2):
        part = spark.createDataFrame(data[load - 1], schema)
        checks.add(load, part, parents={"customers": spark.createDataFrame(customers[load - 1], "customer_id long")})
    # the second order is replaced
    changed = [(2, 6, None, None, None, 1)]
    removed = spark.createDataFrame(data[0][1:], schema)
    checks.add(3, spark.createDataFrame(changed, schema), removed)
    whole = spark.createDataFrame([data[0][0], *changed, *data[1]], schema)
    parents = {
        "customers": spark.createDataFrame([(5,), (6,)], "customer_id long"),
        "customer_addresses": spark.createDataFrame([], "address_id long"),
    }
    want = check_entity(whole, entity, parents)
    found = checks.violations()
    assert list(found) == list(want)
    assert {name: rows(df) for name, df in found.items()} == {name: rows(df) for name, df in want.items()}
    assert rows(found["unique"]) == [(1, 2)] and rows(found["foreign_key_customers"]) == [(7, 1)]
