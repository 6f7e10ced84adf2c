"""Rules that hold for any input, on generated frames."""

import random

import pytest
from helpers import T, rows

from tiermart.operators.dedupe import dedupe_latest
from tiermart.operators.merge import scd1_upsert, scd2_apply, scd2_pass

DIM = (
    "k int, a string, b string, effective_start_date timestamp_ntz, "
    "effective_end_date timestamp_ntz, is_current boolean, last_updated_ts timestamp_ntz"
)
SOURCE = "k int, a string, b string, last_updated_ts timestamp_ntz"

seeds = pytest.mark.parametrize("seed", range(4))


def _value(rng):
    return rng.choice(["x", "y", "z", None])


def _source(spark, rng, day):
    keys = rng.sample(range(40), 25)
    return spark.createDataFrame([(k, _value(rng), _value(rng), T[day]) for k in keys], SOURCE)


def _dim(spark, rng):
    data = []
    for k in rng.sample(range(40), 25):
        for _ in range(rng.randrange(3)):
            data.append((k, _value(rng), _value(rng), T[0], T[1], False, T[0]))
        data.append((k, _value(rng), _value(rng), T[1], None, True, T[1]))
    return spark.createDataFrame(data, DIM)


@seeds
@pytest.mark.parametrize("null_safe", [False, True])
def test_two_passes_are_one_apply(spark, seed, null_safe):
    rng = random.Random(seed)
    dim, source = _dim(spark, rng), _source(spark, rng, 3)
    rules = dict(null_safe=null_safe, source_unique=True)
    once = scd2_pass(dim, source, ["k"], ["a", "b"], T[4], **rules)
    twice = scd2_pass(once, source, ["k"], ["a", "b"], T[4], **rules)
    applied = scd2_apply(dim, source, ["k"], ["a", "b"], T[4], **rules)
    assert rows(applied) == rows(twice)
    thrice = scd2_pass(twice, source, ["k"], ["a", "b"], T[5], **rules)
    assert rows(thrice) == rows(twice)


@seeds
def test_both_ways_to_match_agree(spark, seed):
    rng = random.Random(seed)
    dim, source = _dim(spark, rng), _source(spark, rng, 3)
    for merge in (scd2_pass, scd2_apply):
        whole = merge(dim, source, ["k"], ["a", "b"], T[4], source_unique=True)
        lookup = merge(dim, source, ["k"], ["a", "b"], T[4], source_unique=False)
        assert rows(whole) == rows(lookup)
    target = dim.filter("is_current").select("k", "a", "b", "last_updated_ts")
    new = source.drop("last_updated_ts")
    whole = scd1_upsert(target, new, ["k"], run_ts=T[4], source_unique=True)
    assert rows(whole) == rows(scd1_upsert(target, new, ["k"], run_ts=T[4]))


@seeds
def test_versions_of_a_key_do_not_overlap(spark, seed):
    rng = random.Random(seed)
    dim = spark.createDataFrame([], DIM)
    for day in range(1, 5):
        dim = scd2_apply(
            dim, _source(spark, rng, day), ["k"], ["a", "b"], T[day], source_unique=True
        )
    by_key = {}
    for r in dim.collect():
        by_key.setdefault(r.k, []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r.effective_start_date)
        assert [r.is_current for r in versions] == [False] * (len(versions) - 1) + [True]
        for old, new in zip(versions, versions[1:]):
            assert old.effective_end_date == new.effective_start_date
        assert versions[-1].effective_end_date is None


@seeds
def test_upsert_is_idempotent(spark, seed):
    rng = random.Random(seed)
    target = _source(spark, rng, 1)
    source = _source(spark, rng, 2).drop("last_updated_ts")
    once = scd1_upsert(target, source, ["k"], run_ts=T[4], source_unique=True)
    again = scd1_upsert(once, source, ["k"], run_ts=T[4], source_unique=True)
    assert rows(once) == rows(again)


@seeds
def test_dedupe_does_not_depend_on_input_order(spark, seed):
    rng = random.Random(seed)
    data = [(rng.randrange(5), rng.randrange(3), _value(rng)) for _ in range(60)]
    expected = None
    for parts in (1, 3, 7):
        rng.shuffle(data)
        df = spark.createDataFrame(data, "k int, t int, v string").repartition(parts)
        found = rows(dedupe_latest(df, ["k"], ["t"]))
        assert expected in (None, found)
        expected = found
    assert len(expected) == len({r[0] for r in data})
