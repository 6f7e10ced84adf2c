import pytest
from helpers import T, rows

from tiermart.operators.merge import (
    AMBIGUOUS,
    ambiguous_keys,
    append_rows,
    merge_insert_only,
    scd1_upsert,
    scd2_apply,
    scd2_pass,
)

CLEAN = "k int, v string, last_updated_ts timestamp_ntz, is_active string"
SOURCE = "k int, v string"
DIM = (
    "k int, v string, effective_start_date timestamp_ntz, effective_end_date timestamp_ntz, "
    "is_current boolean, last_updated_ts timestamp_ntz"
)
DIM_SOURCE = "k int, v string, last_updated_ts timestamp_ntz"

# every way to match must give the same result
WAYS = [
    dict(source_unique=False),
    dict(source_unique=True),
    dict(source_unique=True, incremental=True),
    dict(source_unique=False, incremental=True),
]
ways = pytest.mark.parametrize("way", WAYS, ids=["guarded", "whole", "lookup", "guarded_lookup"])


@ways
def test_scd1_updates_inserts_and_keeps(spark, way):
    target = spark.createDataFrame([(1, "x", T[0], "yes"), (2, "y", T[0], "no")], CLEAN)
    source = spark.createDataFrame([(2, "z"), (3, "w")], SOURCE)
    merged = scd1_upsert(target, source, ["k"], run_ts=T[1], **way)
    assert merged.schema.names == target.schema.names
    assert rows(merged) == [(1, "x", T[0], "yes"), (2, "z", T[1], "no"), (3, "w", T[1], "yes")]


@ways
def test_scd1_null_replaces_value_and_null_key_never_matches(spark, way):
    target = spark.createDataFrame([(1, "x", T[0], "yes"), (None, "n", T[0], "yes")], CLEAN)
    source = spark.createDataFrame([(1, None), (None, "m")], SOURCE)
    merged = scd1_upsert(target, source, ["k"], run_ts=T[1], **way)
    assert rows(merged) == sorted(
        [(1, None, T[1], "yes"), (None, "n", T[0], "yes"), (None, "m", T[1], "yes")], key=repr
    )


def test_scd1_several_matches_raise(spark):
    target = spark.createDataFrame([(2, "y", T[0], "yes")], CLEAN)
    source = spark.createDataFrame([(2, "z"), (2, "q"), (3, "w")], SOURCE)
    with pytest.raises(Exception, match=AMBIGUOUS):
        scd1_upsert(target, source, ["k"], run_ts=T[1]).collect()
    assert rows(ambiguous_keys(target, source, ["k"])) == [(2, 2)]


def test_scd1_several_new_rows_of_a_key_all_insert(spark):
    target = spark.createDataFrame([(1, "x", T[0], "yes")], CLEAN)
    source = spark.createDataFrame([(2, "z"), (2, "q")], SOURCE)
    merged = scd1_upsert(target, source, ["k"], run_ts=T[1])
    assert rows(merged) == [(1, "x", T[0], "yes"), (2, "q", T[1], "yes"), (2, "z", T[1], "yes")]


@ways
def test_scd1_updates_every_target_row_of_a_key(spark, way):
    target = spark.createDataFrame([(1, "x", T[0], "yes"), (1, "y", T[0], "yes")], CLEAN)
    source = spark.createDataFrame([(1, "z")], SOURCE)
    merged = scd1_upsert(target, source, ["k"], run_ts=T[1], **way)
    assert rows(merged) == [(1, "z", T[1], "yes")] * 2


@ways
def test_scd1_set_columns(spark, way):
    target = spark.createDataFrame(
        [(7, 1, "x", T[0])], "address_id int, k int, v string, last_updated_ts timestamp_ntz"
    )
    source = spark.createDataFrame([(8, 1, "y"), (9, 2, "z")], "address_id int, k int, v string")
    merged = scd1_upsert(target, source, ["k"], set_columns=["v"], run_ts=T[1], **way)
    assert rows(merged) == [(7, 1, "y", T[1]), (9, 2, "z", T[1])]


def _dim(spark):
    return spark.createDataFrame(
        [(0, "h", T[0], T[1], False, T[1]), (1, "x", T[0], None, True, T[0])], DIM
    )


@ways
def test_scd2_pass_by_pass(spark, way):
    source = spark.createDataFrame([(1, "y", T[3]), (2, "w", T[3])], DIM_SOURCE)
    closed = [
        (0, "h", T[0], T[1], False, T[1]),
        (1, "x", T[0], T[4], False, T[3]),
        (2, "w", T[4], None, True, T[3]),
    ]
    one = scd2_pass(_dim(spark), source, ["k"], ["v"], T[4], **way)
    assert rows(one) == sorted(closed, key=repr)
    two = scd2_pass(one, source, ["k"], ["v"], T[5], **way)
    assert rows(two) == sorted([*closed, (1, "y", T[5], None, True, T[3])], key=repr)
    three = scd2_pass(two, source, ["k"], ["v"], T[6], **way)
    assert rows(three) == rows(two)


@ways
def test_scd2_apply_closes_and_opens(spark, way):
    source = spark.createDataFrame([(1, "y", T[3]), (2, "w", T[3])], DIM_SOURCE)
    state = scd2_apply(_dim(spark), source, ["k"], ["v"], T[4], **way)
    assert state.schema.names == _dim(spark).schema.names
    assert rows(state) == sorted(
        [
            (0, "h", T[0], T[1], False, T[1]),
            (1, "x", T[0], T[4], False, T[3]),
            (1, "y", T[4], None, True, T[3]),
            (2, "w", T[4], None, True, T[3]),
        ],
        key=repr,
    )
    again = scd2_apply(state, source, ["k"], ["v"], T[5], **way)
    assert rows(again) == rows(state)


@ways
@pytest.mark.parametrize("merge", [scd2_pass, scd2_apply])
def test_scd2_change_to_null(spark, way, merge):
    source = spark.createDataFrame([(1, None, T[3])], DIM_SOURCE)
    plain = merge(_dim(spark), source, ["k"], ["v"], T[4], **way)
    assert rows(plain) == rows(_dim(spark))
    safe = merge(_dim(spark), source, ["k"], ["v"], T[4], null_safe=True, **way)
    assert (1, "x", T[0], T[4], False, T[3]) in rows(safe)
    assert ((1, None, T[4], None, True, T[3]) in rows(safe)) == (merge is scd2_apply)


@ways
def test_scd2_moved_address_opens_second_version(spark, way):
    schema = DIM.replace("k int, v string", "address_id int, customer_id int, city string")
    dim = spark.createDataFrame([(5, 1, "A", T[0], None, True, T[0])], schema)
    source = spark.createDataFrame(
        [(5, 2, "A", T[3])],
        "address_id int, customer_id int, city string, last_updated_ts timestamp_ntz",
    )
    state = scd2_apply(dim, source, ["address_id", "customer_id"], ["city"], T[4], **way)
    assert rows(state) == [
        (5, 1, "A", T[0], None, True, T[0]),
        (5, 2, "A", T[4], None, True, T[3]),
    ]


@pytest.mark.parametrize("merge", [scd2_pass, scd2_apply])
def test_scd2_several_matches_raise(spark, merge):
    source = spark.createDataFrame([(1, "y", T[3]), (1, "z", T[3])], DIM_SOURCE)
    with pytest.raises(Exception, match=AMBIGUOUS):
        merge(_dim(spark), source, ["k"], ["v"], T[4]).collect()


@ways
def test_scd2_null_flag_counts_as_history(spark, way):
    dim = spark.createDataFrame([(1, "x", T[0], None, None, T[0])], DIM)
    source = spark.createDataFrame([(1, "y", T[3])], DIM_SOURCE)
    state = scd2_apply(dim, source, ["k"], ["v"], T[4], **way)
    assert rows(state) == sorted(
        [(1, "x", T[0], None, None, T[0]), (1, "y", T[4], None, True, T[3])], key=repr
    )


@pytest.mark.parametrize("incremental", [False, True])
def test_insert_only_merge(spark, incremental):
    schema = "k int, v string, last_updated_ts timestamp_ntz"
    target = spark.createDataFrame([(1, "x", T[0])], schema)
    source = spark.createDataFrame([(1, "changed", T[1]), (2, "w", T[1])], schema)
    once = merge_insert_only(target, source, ["k"], T[2])
    assert rows(once) == [(1, "x", T[0]), (2, "w", T[2])]
    assert rows(merge_insert_only(once, source, ["k"], T[3])) == rows(once)


def test_append_repeats(spark):
    schema = "k int, v string, last_updated_ts timestamp_ntz"
    target = spark.createDataFrame([(1, "x", T[0])], schema)
    source = spark.createDataFrame([(1, "x", T[1])], schema)
    assert rows(append_rows(target, source, T[2])) == [(1, "x", T[0]), (1, "x", T[2])]


def test_several_lazy_passes_plan(spark):
    """Chained merges without a write in between."""
    dim = _dim(spark)
    for day in range(3, 7):
        source = spark.createDataFrame([(1, f"v{day}", T[day])], DIM_SOURCE)
        dim = scd2_apply(dim, source, ["k"], ["v"], T[day], source_unique=True)
    assert dim.filter("is_current").count() == 1
    assert dim.count() == 6


def test_default_time_is_now(spark):
    target = spark.createDataFrame([], CLEAN)
    source = spark.createDataFrame([(1, "a")], SOURCE)
    row = scd1_upsert(target, source, ["k"]).first()
    assert row.last_updated_ts.year >= 2024
