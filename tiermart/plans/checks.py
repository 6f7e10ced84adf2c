"""Declared checks that read what a load brings, and numbers of rows per key, instead of whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermart.operators.quality import check_not_null
from tiermart.schemas import Entity
from tiermart.sources.segments import Segments
from tiermart.sources.tables import COMMON, Layers

ROWS, PARENTS = "row_count", "parent_count"


class KeyCounts:
    """How many rows of a table, and of its parent, hold each value of some columns.

    Counts lie in buckets of the key. A load adds its own counts, of which every task has combined its rows before
    they are shuffled, and rewrites the buckets that they fall into. Loads have ascending numbers, and the number of
    the last one is published with the counts: a load that is repeated changes nothing. NULL is a value like
    others here; the checks say what it means.
    """

    def __init__(self, layers: Layers, name: str, keys: Sequence[T.StructField], buckets: int = 64) -> None:
        self.layers = layers
        self.keys = [f.name for f in keys]
        counts = [T.StructField(c, T.LongType()) for c in (ROWS, PARENTS)]
        schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in keys], *counts])
        self.held = Segments(layers, COMMON, f"keys_{name}", schema, self.keys, buckets)

    def _counts(self, rows: DataFrame, columns: Sequence[str], side: str, sign: int) -> DataFrame:
        pairs = zip(columns, self.keys)
        keys = rows.select(*[F.col(c).cast(self.held.schema[k].dataType).alias(k) for c, k in pairs])
        number = (F.count(F.lit(1)) * sign).cast("bigint")
        return self._both(keys.groupBy(*self.keys).agg(number.alias(side)))

    def _both(self, counts: DataFrame) -> DataFrame:
        absent = F.lit(0).cast("bigint")
        return counts.select(
            *self.keys, *[F.col(c) if c in counts.columns else absent.alias(c) for c in (ROWS, PARENTS)]
        )

    def add(
        self,
        load: int,
        added: DataFrame | None = None,
        removed: DataFrame | None = None,
        parents: DataFrame | None = None,
        parents_removed: DataFrame | None = None,
        parent_columns: Sequence[str] | None = None,
        counts: DataFrame | None = None,
    ) -> Sequence[int]:
        """Take in the rows that a load added to the table and its parent, and those it removed.

        `counts` (keys, row_count) are rows that are counted already. Returns the buckets that were written.
        """
        done = self.held.marks()
        if done and load <= done[0]:
            return []
        above = parent_columns or self.keys
        given = [
            self._counts(rows, columns, side, sign)
            for rows, columns, side, sign in (
                (added, self.keys, ROWS, 1),
                (removed, self.keys, ROWS, -1),
                (parents, above, PARENTS, 1),
                (parents_removed, above, PARENTS, -1),
            )
            if rows is not None
        ]
        if counts is not None:
            given.append(self._both(counts))
        if not given:
            return []
        # stored: it tells the buckets first and is added to them then
        delta = self.layers.stage(f"{self.held.table}_new", self._sum(given))
        touched = self.held.touched(delta)
        before = self.held.open_rows(touched)
        now = self._sum([before, delta]).filter((F.col(ROWS) != 0) | (F.col(PARENTS) != 0))
        self.held.rewrite(now, touched, [load])
        return touched

    def _sum(self, counts: Sequence[DataFrame]) -> DataFrame:
        every = reduce(DataFrame.unionByName, counts)
        return every.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in (ROWS, PARENTS)])

    def counts(self) -> DataFrame:
        """(keys, row_count, parent_count) after all loads."""
        return self.held.open_rows()

    def repeated(self) -> DataFrame:
        """Keys held by more than one row, as `check_unique` finds them."""
        return self.counts().filter(F.col(ROWS) > 1).drop(PARENTS)

    def orphans(self) -> DataFrame:
        """Values without a parent, as `check_foreign_key` finds them; NULL keys are no violation."""
        found = self.counts().filter((F.col(ROWS) > 0) & (F.col(PARENTS) <= 0))
        return found.dropna(subset=self.keys).drop(PARENTS)


class EntityChecks:
    """All declared checks of an entity, kept up by its loads and those of its parents."""

    def __init__(self, layers: Layers, entity: Entity, buckets: int = 64) -> None:
        self.entity = entity
        name, fields = entity.name, entity.curated_schema
        self.unique = KeyCounts(layers, f"{name}_unique", [fields[k] for k in entity.key], buckets)
        self.nulls = KeyCounts(layers, f"{name}_nulls", [T.StructField("column_name", T.StringType())], 1)
        self.foreign = {
            (tuple(columns), parent): KeyCounts(
                layers, f"{name}_{'_'.join(columns)}_{parent}", [fields[c] for c in columns], buckets
            )
            for columns, parent, _ in entity.foreign_keys
        }

    def add(
        self,
        load: int,
        added: DataFrame | None = None,
        removed: DataFrame | None = None,
        parents: Mapping[str, DataFrame] | None = None,
        parents_removed: Mapping[str, DataFrame] | None = None,
    ) -> None:
        """Take in a load: new rows, rows that are gone or are replaced by new ones, and the same of parents by name.

        Every check publishes on its own; if one fails, the load is repeated with its number, and only what
        is not in yet is added.
        """
        above, gone = parents or {}, parents_removed or {}
        self.unique.add(load, added, removed)
        required = self.entity.required_columns
        if required:
            signed = [
                check_not_null(rows, required).select("column_name", (F.col("null_count") * sign).alias(ROWS))
                for rows, sign in ((added, 1), (removed, -1))
                if rows is not None
            ]
            if signed:
                self.nulls.add(load, counts=reduce(DataFrame.unionByName, signed))
        for columns, parent, parent_columns in self.entity.foreign_keys:
            self.foreign[tuple(columns), parent].add(
                load, added, removed, above.get(parent), gone.get(parent), parent_columns
            )

    def violations(self) -> dict[str, DataFrame]:
        """By name of the check, what `check_entity` finds in the whole tables."""
        found = {"unique": self.unique.repeated()}
        if self.entity.required_columns:
            counts = self.nulls.counts().filter(F.col(ROWS) > 0)
            found["not_null"] = counts.select("column_name", F.col(ROWS).alias("null_count"))
        for (_, parent), kept in self.foreign.items():
            found[f"foreign_key_{parent}"] = kept.orphans()
        return found
