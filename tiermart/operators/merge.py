"""Upserts, versioned dimensions and fact loads as DataFrame operators.

Each operator returns the new state of the target (or the rows to append) and
leaves writing to the caller. There are two ways to match, with the same result:

- Whole: target and source meet in one full outer join, one shuffle of each.
  Taken if the caller vouches for unique source keys (`source_unique`), so that
  no key can be hot.
- Lookup: the target stays on the preserved side of a left join, and new rows
  are found by a left-anti join on key columns only. Taken for sources whose
  keys may repeat, with hot keys of the target divided between tasks, and for
  `incremental` sources: a small one is broadcast by Spark's own size check and
  the target is then not shuffled at all.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermart.functions import any_changed, run_timestamp
from tiermart.functions.columns import RunTs
from tiermart.operators.skew import divided_join
from tiermart.schemas import (
    ACTIVE_FLAG,
    ACTIVE_VALUE,
    IS_CURRENT,
    UPDATED_TS,
    VALID_FROM,
    VALID_TO,
)

AMBIGUOUS = "ambiguous merge: several source rows match one target row"

_SOURCE = "__source"
_COUNT = "__count"


def _packed(
    source: DataFrame, keys: Sequence[str], columns: Sequence[str], unique: bool
) -> DataFrame:
    """Keys, one struct of the source columns, and the rows per key.

    Unless the caller vouches for unique keys they are counted; the count is
    combined on the map side, so copies of one key do not pile up in a task.
    """
    packed = source.select(*keys, F.struct(*columns).alias(_SOURCE))
    if unique:
        return packed.withColumn(_COUNT, F.lit(1).cast("bigint"))
    return packed.groupBy(*keys).agg(
        F.any_value(_SOURCE).alias(_SOURCE), F.count(F.lit(1)).alias(_COUNT)
    )


def _looked_up(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    source_unique: bool,
) -> DataFrame:
    """Target rows with the packed source row of their key.

    Unless the caller vouches for unique source keys, those of the target may
    repeat as well, and hot ones are divided.
    """
    packed = _packed(source, keys, columns, source_unique)
    if source_unique:
        return target.join(packed, list(keys), "left")
    return divided_join(target, packed, keys, "left")


def _guarded(value: Column) -> Column:
    """`value` for a match by one source row, an error for a match by several."""
    several = F.coalesce(F.col(_COUNT) > 1, F.lit(False))
    return F.when(several, F.raise_error(F.lit(AMBIGUOUS)).cast("boolean")).otherwise(
        F.col(_COUNT).isNotNull() & value
    )


def _unmatched(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    source_unique: bool,
    incremental: bool,
) -> DataFrame:
    """Source rows whose key the target does not hold.

    For an incremental source the target's keys are first cut to those of the
    source, which takes no shuffle if the source is small enough to broadcast.
    """
    held = target.select(*keys)
    if incremental:
        held = held.join(source.select(*keys), list(keys), "left_semi")
    if source_unique:
        return source.join(held, list(keys), "left_anti")
    return divided_join(source, held.distinct(), keys, "left_anti")


def ambiguous_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the target that several source rows match, with `source_rows`.

    A merge on these keys would raise; this names them beforehand.
    """
    counts = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("source_rows"))
    return counts.filter("source_rows > 1").join(target.select(*keys), list(keys), "left_semi")


def scd1_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    set_columns: Sequence[str] | None = None,
    run_ts: RunTs = None,
    insert_defaults: Mapping[str, str] | None = None,
    source_unique: bool = False,
    incremental: bool = False,
    newer_by: Sequence[str] = (),
) -> DataFrame:
    """Overwrite matched rows, insert new ones, keep the rest of the target.

    With `newer_by`, a source row that is older in these columns, compared in turn with NULL as the
    oldest, leaves its target row as it is.

    `set_columns` are overwritten on a match (default: every source column that
    is not a key); other target columns keep their value. Inserts take the
    source columns, `insert_defaults` for the rest. Both write `last_updated_ts`.
    A target row matched by several source rows raises an error. NULL keys never
    match.
    """
    now = run_timestamp(run_ts)
    if set_columns is None:
        set_columns = [c for c in source.columns if c not in keys]
    if insert_defaults is None:
        insert_defaults = {ACTIVE_FLAG: ACTIVE_VALUE} if ACTIVE_FLAG in target.columns else {}

    def updated(f: T.StructField, hit: Column, kept: Column, given: Column) -> Column:
        if f.name == UPDATED_TS:
            return F.when(hit, now).otherwise(kept)
        if f.name in set_columns:
            return F.when(hit, given[f.name].cast(f.dataType)).otherwise(kept)
        return kept

    def inserted(f: T.StructField, given: Column | None) -> Column:
        if f.name == UPDATED_TS:
            return now
        if f.name in source.columns:
            return (F.col(f.name) if given is None else given[f.name]).cast(f.dataType)
        return F.lit(insert_defaults.get(f.name)).cast(f.dataType)

    def not_older(kept: Callable[[str], Column], given: Column) -> Column:
        if not newer_by:
            return F.lit(True)
        return F.struct(*[given[c] for c in newer_by]) >= F.struct(*[kept(c) for c in newer_by])

    if source_unique and not incremental:
        old, new = F.col("__target"), F.col(_SOURCE)
        pairs = target.select(*keys, F.struct(*target.columns).alias("__target")).join(
            source.select(*keys, F.struct(*source.columns).alias(_SOURCE)), list(keys), "full"
        )
        hit = new.isNotNull() & not_older(old.getField, new)
        return pairs.select(
            *[
                F.when(old.isNull(), inserted(f, new))
                .otherwise(updated(f, hit, old[f.name], new))
                .alias(f.name)
                for f in target.schema
            ]
        )

    looked_up = list(dict.fromkeys([*set_columns, *newer_by]))
    joined = _looked_up(target, source, keys, looked_up, source_unique)
    joined = joined.withColumn("__hit", _guarded(not_older(F.col, F.col(_SOURCE))))
    rows = joined.select(
        *[
            updated(f, F.col("__hit"), F.col(f.name), F.col(_SOURCE)).alias(f.name)
            for f in target.schema
        ]
    )
    fresh = _unmatched(source, target, keys, source_unique, incremental)
    return rows.unionByName(
        fresh.select(*[inserted(f, None).alias(f.name) for f in target.schema])
    )


def _closed_row(
    dim: DataFrame, kept: Callable[[str], Column], close: Column, now: Column, changed_ts: Column
) -> list[Column]:
    """Columns of a current version, closed where `close` holds."""
    values = {
        VALID_TO: F.when(close, now).otherwise(kept(VALID_TO)),
        IS_CURRENT: kept(IS_CURRENT) & ~close,
        UPDATED_TS: F.when(close, changed_ts).otherwise(kept(UPDATED_TS)),
    }
    return [values.get(c, kept(c)).alias(c) for c in dim.columns]


def _opened_row(dim: DataFrame, given: Callable[[str], Column], now: Column) -> list[Column]:
    """Columns of a new current version."""
    values = {VALID_FROM: now, VALID_TO: F.lit(None), IS_CURRENT: F.lit(True)}
    return [
        (values[f.name] if f.name in values else given(f.name)).cast(f.dataType).alias(f.name)
        for f in dim.schema
    ]


def _merge_versions(
    dim: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    run_ts: RunTs,
    null_safe: bool,
    source_unique: bool,
    incremental: bool,
    successors: bool,
) -> DataFrame:
    now = run_timestamp(run_ts)
    is_current = F.col(IS_CURRENT)
    # closed versions are passed through and take no part in any join
    history = dim.filter(is_current.isNull() | ~is_current)
    current = dim.filter(is_current)

    if source_unique and not incremental:
        old, new = F.col("__target"), F.col(_SOURCE)
        pairs = current.select(*keys, F.struct(*dim.columns).alias("__target")).join(
            source.select(*keys, F.struct(*source.columns).alias(_SOURCE)), list(keys), "full"
        )
        differs = any_changed([(old[c], new[c]) for c in tracked], null_safe)
        close = old.isNotNull() & new.isNotNull() & differs
        closed = F.struct(*_closed_row(dim, old.getField, close, now, new[UPDATED_TS]))
        opened = F.struct(*_opened_row(dim, new.getField, now))
        if successors:
            both = F.array(
                F.when(old.isNotNull(), closed), F.when(old.isNull() | close, opened)
            )
            rows = pairs.select(F.explode(both).alias("__row")).filter("__row IS NOT NULL")
        else:
            rows = pairs.select(F.when(old.isNull(), opened).otherwise(closed).alias("__row"))
        return history.unionByName(rows.select("__row.*"))

    joined = _looked_up(current, source, keys, [*tracked, UPDATED_TS], source_unique)
    differs = any_changed([(F.col(c), F.col(_SOURCE)[c]) for c in tracked], null_safe)
    joined = joined.withColumn("__close", _guarded(differs))
    closed = joined.select(
        *_closed_row(dim, F.col, F.col("__close"), now, F.col(_SOURCE)[UPDATED_TS])
    )
    if successors:
        # a source row is new unless a current version of its key stays open
        before = {c: f"__held_{c}" for c in tracked}
        held = current.select(*keys, *[F.col(c).alias(name) for c, name in before.items()])
        differs = any_changed([(F.col(name), F.col(c)) for c, name in before.items()], null_safe)
        fresh = divided_join(source, held, keys, "left_anti", [~differs])
    else:
        fresh = _unmatched(source, current, keys, source_unique, incremental)
    opened = fresh.select(*_opened_row(dim, F.col, now))
    return history.unionByName(closed).unionByName(opened)


def scd2_pass(
    dim: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    run_ts: RunTs = None,
    null_safe: bool = False,
    source_unique: bool = False,
    incremental: bool = False,
) -> DataFrame:
    """One merge of a versioned dimension.

    A current version whose tracked attributes differ is closed; a source row
    without a current version opens one. The new version of a closed row
    therefore appears at the next pass, see `scd2_apply` for both at once.
    """
    return _merge_versions(
        dim, source, keys, tracked, run_ts, null_safe, source_unique, incremental, False
    )


def scd2_apply(
    dim: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    run_ts: RunTs = None,
    null_safe: bool = False,
    source_unique: bool = False,
    incremental: bool = False,
) -> DataFrame:
    """Close changed versions and open their successors at the same time."""
    return _merge_versions(
        dim, source, keys, tracked, run_ts, null_safe, source_unique, incremental, True
    )


def new_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    run_ts: RunTs = None,
    source_unique: bool = False,
    incremental: bool = False,
) -> DataFrame:
    """Source rows whose key the target does not hold, stamped, ready to append."""
    fresh = _unmatched(source, target, keys, source_unique, incremental)
    return stamped(fresh, target.columns, run_ts)


def stamped(source: DataFrame, columns: Sequence[str], run_ts: RunTs = None) -> DataFrame:
    """The listed columns, `last_updated_ts` set to the time of the run."""
    now = run_timestamp(run_ts)
    return source.select(*[now.alias(c) if c == UPDATED_TS else F.col(c) for c in columns])


def merge_insert_only(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    run_ts: RunTs = None,
    source_unique: bool = False,
    incremental: bool = False,
) -> DataFrame:
    """Target plus unseen source rows; rows already there never change."""
    return target.unionByName(
        new_rows(target, source, keys, run_ts, source_unique, incremental)
    )


def append_rows(target: DataFrame, source: DataFrame, run_ts: RunTs = None) -> DataFrame:
    """Target plus every source row; repeating it repeats the rows."""
    return target.unionByName(stamped(source, target.columns, run_ts))
