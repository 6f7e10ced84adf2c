"""Joins on keys of which one may hold a large share of the rows.

Spark splits a hot partition at run time only if both join sides come straight
from a shuffle, and only along the tasks that wrote it. Where several tables
meet on one key, hot keys are therefore found beforehand and their rows placed
in cells: a table with many rows of a key is divided over the cells, the other
tables of the join repeat their rows in every cell. Each matching combination
still meets exactly once; nothing is dropped or sampled. Keys that are not hot
have a single cell and take the ordinary path.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key is looked for from this share of a table's rows, so at most 200 keys of
# a table are hot. It is raised where shuffle partitions are so few that such a
# key would not stand out of one.
SMALLEST_SHARE, LARGEST_SHARE = 0.005, 0.1

# Frequent keys are counted in sketches of fixed size, one for every group of
# input partitions, so neither a task nor the driver ever holds more.
_GROUPS, _TOP, _TRACKED = 1024, 200, 2048

# A table whose estimated size on disk is below this is not looked at: a task that got all rows
# of one of its keys would still hold less than what Spark calls a skewed partition.
SMALLEST_TABLE = 64 * 1024 * 1024

CELL = "__cell"


def hot_keys(df: DataFrame, key_sets: Sequence[Sequence[str]], share: float) -> DataFrame:
    """(number of the key set, hash of its columns, share of the rows) of frequent keys.

    One pass over the key columns for all sets, few rows as a result. The counts
    are estimates: they decide where rows are placed, never which rows are kept.
    """
    numbers = range(len(key_sets))
    sketches = (
        df.select(
            *[F.xxhash64(*keys).alias(f"k{n}") for n, keys in enumerate(key_sets)],
            (F.spark_partition_id() % _GROUPS).alias("g"),
        )
        .groupBy("g")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.expr(f"approx_top_k(k{n}, {_TOP}, {_TRACKED})").alias(f"t{n}") for n in numbers],
        )
    )

    def numbered(n: int) -> Column:
        return F.transform(
            f"t{n}", lambda t: F.struct(F.lit(n).alias("set"), t["item"], t["count"])
        )

    counts = F.flatten(F.array(*[numbered(n) for n in numbers]))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return (
        sketches.withColumn("total", total)
        .select("total", F.explode(counts).alias("c"))
        .groupBy("c.set", F.col("c.item").alias("key"))
        .agg((F.sum("c.count") / F.first("total")).alias("share"))
        .filter(F.col("share") >= share)
    )


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate; of a join it is an upper bound."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_broadcast(df: DataFrame) -> bool:
    """Whether Spark will send the table whole to every task by its own size check."""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return estimated_bytes(df) <= conf.autoBroadcastJoinThreshold()


@dataclass(frozen=True)
class Cells:
    """Number of cells per hot key, one dimension per table that shares the key."""

    key_types: list[str]
    dimensions: int
    # hash of the key columns -> cells along each dimension
    sizes: dict[int, list[int]] = field(default_factory=dict)
    table: DataFrame | None = None

    def sized(self, spark: SparkSession, sizes: dict[int, list[int]]) -> Cells:
        if not sizes:
            return replace(self, sizes={}, table=None)
        columns = ", ".join(f"__n{i} bigint" for i in range(self.dimensions))
        rows = [(key, *places) for key, places in sizes.items()]
        table = spark.createDataFrame(rows, f"__hot bigint, {columns}")
        return replace(self, sizes=sizes, table=table)

    def any_along(self, dimension: int) -> bool:
        return any(places[dimension] > 1 for places in self.sizes.values())

    def on(self, keys: Sequence[str]) -> list[str]:
        """The columns to join placed tables on."""
        return list(keys) if self.table is None else [*keys, CELL]

    def place(
        self, df: DataFrame, keys: Sequence[str], divided: dict[int, Sequence[str]]
    ) -> DataFrame:
        """Add the cells: along a dimension in `divided` a row takes one place, by
        hash of the given columns; along the others it is repeated in every place.
        Without any hot key the table stays as it is.
        """
        if self.table is None:
            return df
        if _types(df, keys) != self.key_types:
            raise ValueError(f"join keys {list(keys)} differ in type between the tables")
        sizes = [F.col(f"__n{i}") for i in range(self.dimensions)]
        repeated = [i for i in range(self.dimensions) if i not in divided and self.any_along(i)]
        copies = F.lit(1).cast("bigint")
        for i in repeated:
            copies = copies * sizes[i]

        def cell(copy: Column) -> Column:
            place = {i: F.pmod(F.xxhash64(*cols), sizes[i]) for i, cols in divided.items()}
            for i in reversed(repeated):
                place[i] = copy % sizes[i]
                copy = F.floor(copy / sizes[i])
            code = F.lit(0).cast("bigint")
            for i in range(self.dimensions):
                code = code * sizes[i] + place.get(i, F.lit(0))
            return code

        hot = F.broadcast(self.table)
        found = df.join(hot, F.xxhash64(*keys) == F.col("__hot"), "left")
        usual, first = F.col("__n0").isNull(), F.lit(0).cast("bigint")
        if not repeated:
            one = F.when(usual, first).otherwise(cell(first))
            return found.select(*df.columns, one.alias(CELL))
        every = F.transform(F.sequence(first, copies - 1), cell)
        cells = F.when(usual, F.array(first)).otherwise(every)
        return found.select(*df.columns, F.explode(cells).alias(CELL))


def _types(df: DataFrame, keys: Sequence[str]) -> list[str]:
    kinds = dict(df.dtypes)
    return [kinds[k] for k in keys]


def no_cells(df: DataFrame, keys: Sequence[str], dimensions: int = 1) -> Cells:
    return Cells(_types(df, keys), dimensions)


def find_cells(
    joins: Mapping[str, Sequence[tuple[DataFrame, Sequence[str]]]], share: float | None = None
) -> dict[str, Cells]:
    """Cells for each named join, given its tables with their key columns.

    Runs one small job for all joins of tables that are large enough to have hot keys, none if
    there is no such table. A hot key gets as many cells along a
    table's dimension as make each hold about half an average shuffle partition.
    """
    # joins of one table are looked at in one pass over it
    by_table: dict[int, list[tuple[str, int, Sequence[str]]]] = {}
    frames: dict[int, DataFrame] = {}
    for name, group in joins.items():
        for i, (df, keys) in enumerate(group):
            frames[id(df)] = df
            by_table.setdefault(id(df), []).append((name, i, keys))
    spark = next(iter(frames.values())).sparkSession
    by_table = {t: uses for t, uses in by_table.items() if estimated_bytes(frames[t]) >= SMALLEST_TABLE}
    if not by_table:
        return {name: no_cells(*group[0], len(group)) for name, group in joins.items()}
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if share is None:
        share = min(max(2 / partitions, SMALLEST_SHARE), LARGEST_SHARE)
    found = reduce(
        DataFrame.unionByName,
        [
            hot_keys(frames[t], [keys for _, _, keys in uses], share).withColumn(
                "table", F.lit(t)
            )
            for t, uses in by_table.items()
        ],
    )
    sizes: dict[str, dict[int, list[int]]] = {name: {} for name in joins}
    for row in found.collect():  # at most 1 / share rows per table and key
        name, i, _ = by_table[row.table][row.set]
        places = sizes[name].setdefault(row.key, [1] * len(joins[name]))
        places[i] = max(2, math.ceil(row.share * partitions * 2))

    return {
        name: no_cells(*group[0], len(group)).sized(spark, sizes[name])
        for name, group in joins.items()
    }


def divide_by(
    cells: Cells, df: DataFrame, keys: Sequence[str], by: Sequence[str], first: int, then: int
) -> Cells:
    """Cells that divide the rows of `df` along dimension `first` by the columns `by`,
    and along `then` only as far as rows of a key agree in `by`.

    Tables that know `by` are then not repeated for rows that differ in it. One
    small job, over the hot keys only.
    """
    if not cells.any_along(then):
        return cells
    hot = F.broadcast(cells.table.select("__hot"))
    per_value = (
        df.select(F.xxhash64(*keys).alias("__hot"), *by)
        .join(hot, "__hot")
        .groupBy("__hot", *by)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    largest = per_value.groupBy("__hot").agg((F.max("n") / F.sum("n")).alias("share"))
    agreeing = {row["__hot"]: row.share for row in largest.collect()}  # one row per hot key
    sizes = {key: list(places) for key, places in cells.sizes.items()}
    for key, places in sizes.items():
        places[first] = max(places[first], places[then])
        places[then] = math.ceil(places[then] * agreeing.get(key, 1))
    return cells.sized(df.sparkSession, sizes)


def _holds(kind: T.DataType, parts: tuple[type[T.DataType], ...]) -> bool:
    """Whether a type is or contains one of `parts`."""
    inner = [f.dataType for f in kind.fields] if isinstance(kind, T.StructType) else []
    if isinstance(kind, T.ArrayType):
        inner = [kind.elementType]
    return isinstance(kind, parts) or any(_holds(i, parts) for i in inner)


def divided_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    conditions: Sequence[Column] = (),
) -> DataFrame:
    """`left` joined on `keys` to `right`, which has few rows per key; hot keys of
    `left` are divided. Columns of `right` other than the keys are added.

    `how` keeps the left side: inner, left, left_semi or left_anti.
    """
    unhashable = (T.MapType, T.VariantType)
    for key in keys:
        if isinstance(left.schema[key].dataType, unhashable):
            raise ValueError(f"rows cannot be joined on {key}")
    cells = find_cells({"left": [(left, keys)]})["left"]
    kinds = {f.name: f.dataType for f in left.schema}
    # a value that does not fit the type of the left key cannot equal one
    right = right.withColumns(
        {k: F.col(k).try_cast(kinds[k]) for k in keys if right.schema[k].dataType != kinds[k]}
    )
    hashed = [f.name for f in left.schema if not _holds(f.dataType, unhashable)]
    divided = cells.place(left, keys, {0: hashed})
    repeated = cells.place(right, keys, {})
    on = cells.on(keys)
    if cells.table is not None:
        # an aggregation may have placed `right` by the keys alone; Spark would
        # take that placement for the join and undo the division
        repeated = repeated.repartition(*on)
    repeated = repeated.withColumnsRenamed({k: f"__right_{k}" for k in on})
    same = [F.col(k) == F.col(f"__right_{k}") for k in on]
    joined = divided.join(repeated, [*same, *conditions], how)
    return joined.drop(CELL, *[f"__right_{k}" for k in on])
