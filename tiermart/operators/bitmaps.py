"""Exact numbers of distinct ids from bitmaps, which can be stored per load and merged.

An id of type bigint is a bit of the bitmap of its range of 32,768 ids. Tasks set bits before anything is
shuffled, so what moves is at most 4 kB per group and range, not a row per id; it pays for ids that
lie close, as those of tables usually do.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGE, BITS = "__range", "__bits"


def distinct_state(
    df: DataFrame, groups: Sequence[str], column: str, sums: Mapping[str, Column] | None = None
) -> DataFrame:
    """(groups, __range, __bits, sums): a bit for every id of `column` that a group holds.

    `sums` are added up beside them, by name. Rows with a null id count in the sums only. States of several
    loads are merged by `merge_states`; ids can be added but not taken back.
    """
    return (
        df.withColumn(RANGE, F.bitmap_bucket_number(F.col(column).cast("bigint")))
        .groupBy(*groups, RANGE)
        .agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(F.col(column).cast("bigint"))).alias(BITS),
            *[F.sum(value).alias(name) for name, value in (sums or {}).items()],
        )
    )


def merge_states(states: Sequence[DataFrame], groups: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """One state of several: a bit is set if it is set in any of them."""
    return (
        reduce(DataFrame.unionByName, states)
        .groupBy(*groups, RANGE)
        .agg(F.bitmap_or_agg(BITS).alias(BITS), *[F.sum(name).alias(name) for name in sums])
    )


def distinct_counts(
    state: DataFrame, groups: Sequence[str], alias: str, sums: Sequence[str] = ()
) -> DataFrame:
    """(groups, alias, sums): the number of distinct ids of each group; 0 for all rows of none."""
    count = F.coalesce(F.sum(F.bitmap_count(BITS)), F.lit(0)).cast("bigint")
    return state.groupBy(*groups).agg(
        count.alias(alias), *[F.sum(name).alias(name) for name in sums]
    )
