"""Declared constraints as checks that run as Spark jobs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermart.operators.skew import divided_join
from tiermart.schemas import Entity
from tiermart.session import materialise


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_count) for every listed column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_count")


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with `row_count`."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def check_foreign_key(
    child: DataFrame,
    parent: DataFrame,
    columns: Sequence[str],
    parent_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Key values without a parent, with `row_count`; NULL keys are no violation.

    The child is reduced to one row per key value before the join, so a value
    shared by very many rows crosses the network once per map task.
    """
    wanted = reduce(and_, [F.col(c).isNotNull() for c in columns])
    values = child.filter(wanted).groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))
    return values.join(_parent_keys(parent, columns, parent_columns), list(columns), "left_anti")


def orphan_rows(
    child: DataFrame,
    parent: DataFrame,
    columns: Sequence[str],
    parent_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Whole child rows whose non-NULL key has no parent; hot keys are divided."""
    wanted = reduce(and_, [F.col(c).isNotNull() for c in columns])
    keys = _parent_keys(parent, columns, parent_columns)
    return divided_join(child.filter(wanted), keys, columns, "left_anti")


def _parent_keys(
    parent: DataFrame, columns: Sequence[str], parent_columns: Sequence[str] | None
) -> DataFrame:
    """Key values of the parent under the names of the child, each once."""
    pairs = zip(parent_columns or columns, columns)
    return parent.select(*[F.col(p).alias(c) for p, c in pairs]).distinct()


def check_entity(
    df: DataFrame, entity: Entity, parents: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """All declared checks of an entity by name; parents by entity name."""
    checks = {"unique": check_unique(df, entity.key)}
    if entity.required_columns:
        checks["not_null"] = check_not_null(df, entity.required_columns).filter("null_count > 0")
    for columns, parent, parent_columns in entity.foreign_keys:
        if parent in parents:
            checks[f"foreign_key_{parent}"] = check_foreign_key(
                df, parents[parent], columns, parent_columns
            )
    return checks


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows; a NULL in a listed column aborts the query that reads it."""
    return df.withColumns(
        {
            c: F.when(
                F.col(c).isNull(), F.raise_error(F.lit(f"NULL in required column {c}"))
            ).otherwise(F.col(c))
            for c in columns
        }
    )


def assign_surrogate_key(
    df: DataFrame, key_name: str, order_by: str, start: int = 1
) -> DataFrame:
    """Gapless keys from `start`, ascending by any column that can be sorted.

    NULLs come last; rows with equal values are ordered by the remaining columns. The rows are sorted
    into ranges of about equal size, equal rows included, and stored with the number of
    their range. Each range starts after the rows of all lower ones, a running sum over one
    row per range; a window numbers the rows inside a range.
    """
    others = [
        f.name
        for f in df.schema
        if f.name != order_by and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    place, tie = "__range", "__tie"
    order = [F.asc_nulls_last(c) for c in (order_by, *others, tie)]
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialise(
        # numbers the rows, so that ranges can divide equal ones
        df.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(partitions, *order)
        .withColumn(place, F.spark_partition_id()),
        "ranges",
    )
    sizes = ranged.groupBy(place).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        place, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before")
    )
    numbered = ranged.withColumn(
        "__nth", F.row_number().over(Window.partitionBy(place).orderBy(*order))
    )
    key = (F.col("__before") + F.col("__nth") + F.lit(start - 1)).cast("bigint")
    return numbered.join(offsets, place).select(key.alias(key_name), *df.columns)
