"""Tables of which a load rewrites only the buckets that its rows fall into.

Rows lie in one Parquet table, partitioned by whether they are final, by a bucket of their key, and
by the version that wrote them. The view of the table's name holds, for every bucket, the version to read,
and the versions whose final rows count; these are conditions on partition columns only, so Spark opens no other
folder. A load writes the touched buckets anew under a version of its own, appends rows that became final, and
then replaces the view: readers see all of a load or nothing, and what a failed load has written
is in no view. One writer at a time per table.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermart.sources.tables import Layers

FINAL, BUCKET, VERSION = "_final", "_bucket", "_version"
NO_BUCKET = -1  # final rows are not looked up by key
_NOW, _BEFORE, _FINALS = "segments.versions", "segments.versions_before", "segments.finals"
_MARKS = "segments.marks"


def _numbers(text: str) -> list[int]:
    return [int(n) for n in text.split(",") if n]


@dataclass(frozen=True)
class Segments:
    """A table of rows that `keys` place in one of `buckets`.

    `final` is an SQL condition; rows that meet it never change again: they are appended once, apart from the
    buckets, and no later load reads or writes them. The number of buckets of a table that exists stays as it
    is. What a load rewrites is whole buckets, so a table of a terabyte wants some thousands.
    """

    layers: Layers
    layer: str
    table: str
    schema: T.StructType
    keys: Sequence[str]
    buckets: int
    final: str | None = None

    @property
    def view(self) -> str:
        return self.layers.name(self.layer, self.table)

    @property
    def data(self) -> str:
        return self.layers.name(self.layer, self.layers.data_name(self.table))

    def _properties(self) -> dict[str, list[int]]:
        if not self.layers.exists(self.layer, self.table):
            return {}
        found = self.layers.spark.sql(f"SHOW TBLPROPERTIES {self.view}").collect()
        return {r["key"]: _numbers(r["value"]) for r in found if r["key"].startswith("segments.")}

    def versions(self) -> list[int]:
        """The published version of each bucket, 0 for one that was never written."""
        return self._properties().get(_NOW) or [0] * self.buckets

    def marks(self) -> list[int]:
        """The numbers that the last load published with its rows, none before the first."""
        return self._properties().get(_MARKS, [])

    def bucket(self, df: DataFrame) -> Column:
        """The bucket of a row's key."""
        kinds = {f.name: f.dataType for f in self.schema}
        key = F.xxhash64(*[F.col(k).cast(kinds[k]) for k in self.keys])
        return F.pmod(key, F.lit(len(self.versions()))).cast("int")

    def touched(self, source: DataFrame) -> list[int]:
        """The buckets of the source's keys: numbers below that of the buckets.

        A table that was published otherwise before is taken over whole.
        """
        if self.layers.exists(self.layer, self.table) and _NOW not in self._properties():
            return list(range(self.buckets))
        found = source.select(self.bucket(source).alias("b")).distinct().collect()
        return sorted(row["b"] for row in found)

    def _condition(self, versions: list[int], buckets: Sequence[int] | None = None) -> str:
        listed = ",".join(f"{v}L" for v in versions)
        # below 0 there is no place to look up
        place = f"element_at(array({listed}), greatest({BUCKET}, 0) + 1)"
        only = "" if buckets is None else f" AND {BUCKET} IN ({','.join(map(str, buckets)) or 'NULL'})"
        return f"{FINAL} = 0 AND {VERSION} = {place}{only}"

    def open_rows(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """Rows that may still change, of the given buckets; only these are read."""
        spark, names = self.layers.spark, self.schema.names
        known = self._properties()
        if _NOW in known:
            return spark.table(self.data).where(self._condition(known[_NOW], buckets)).select(*names)
        if self.layers.exists(self.layer, self.table):
            return spark.table(self.view).select(*names)
        return spark.createDataFrame([], self.schema)

    def rewrite(
        self,
        rows: DataFrame,
        touched: Sequence[int],
        marks: Sequence[int] = (),
        further: Callable[[DataFrame, int], Sequence[int]] | None = None,
    ) -> int:
        """Replace the open rows of the touched buckets by `rows`, publish, and return the version.

        `rows` may read `open_rows` of these buckets. Those that are final are appended. `marks` are kept
        beside the versions, so that they change together with the rows. `further` gets the rows as they were
        stored, and the version, before it is published, and returns more marks.
        """
        known = self._properties()
        versions = known.get(_NOW) or [0] * self.buckets
        finals = known.get(_FINALS, [])
        # no two attempts share a number, so nothing that a failed one left is read
        version = max(time.time_ns() // 1000, *(v + 1 for v in versions), *(v + 1 for v in finals))
        spark = self.layers.spark
        self.layers.create_table(
            self.layer,
            self.layers.data_name(self.table),
            T.StructType(
                [
                    *self.schema,
                    T.StructField(FINAL, T.IntegerType()),
                    T.StructField(BUCKET, T.IntegerType()),
                    T.StructField(VERSION, T.LongType()),
                ]
            ),
            partition_by=[FINAL, BUCKET, VERSION],
        )
        final = F.coalesce(F.expr(self.final), F.lit(False)) if self.final else F.lit(False)
        place = self.bucket(rows)
        placed = (
            rows.select(
                *[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema],
                final.cast("int").alias(FINAL),
                F.when(final, NO_BUCKET).otherwise(place).alias(BUCKET),
                F.lit(version).cast("bigint").alias(VERSION),
                place.alias("__place"),
            )
            # one file per bucket, and one of final rows per task; a bucket that is larger than the advisory
            # size of a partition is divided, so that no task has to sort more
            .hint("rebalance", F.col("__place"))
            .sortWithinPartitions(FINAL, BUCKET, *self.keys)
            .drop("__place")
        )
        placed.write.mode("append").insertInto(self.data)
        if further:
            stored = spark.table(self.data).where(F.col(VERSION) == version)
            marks = [*marks, *further(stored.select(*self.schema.names), version)]
        new = list(versions)
        for bucket in touched:
            new[bucket] = version
        if self.final:
            finals = [*finals, version]
        self._publish(new, versions, finals, marks)
        self._forget(known.get(_BEFORE, versions), versions, new)
        for old in self.layers.versions(self.layer, self.table):
            spark.sql(f"DROP TABLE IF EXISTS {self.layers.version_name(self.layer, self.table, old)}")
        return version

    def _publish(
        self, new: list[int], before: list[int], finals: list[int], marks: Sequence[int] = ()
    ) -> None:
        properties = {_NOW: new, _BEFORE: before, _FINALS: finals, _MARKS: marks}
        listed = ", ".join(f"'{k}' = '{','.join(map(str, v))}'" for k, v in properties.items())
        ended = f"{FINAL} = 1 AND {VERSION} IN ({','.join(f'{v}L' for v in finals) or 'NULL'})"
        columns = ", ".join(f"`{c}`" for c in self.schema.names)
        self.layers.spark.sql(
            f"CREATE OR REPLACE VIEW {self.view} TBLPROPERTIES ({listed}) AS "
            f"SELECT {columns} FROM {self.data} WHERE ({self._condition(new)}) OR ({ended})"
        )

    def _forget(self, oldest: list[int], before: list[int], now: list[int]) -> None:
        """Drop the buckets that neither the present nor the last view names."""
        for bucket, version in enumerate(oldest):
            if version and version not in (before[bucket], now[bucket]):
                self.layers.spark.sql(
                    f"ALTER TABLE {self.data} DROP IF EXISTS "
                    f"PARTITION ({FINAL} = 0, {BUCKET} = {bucket}, {VERSION} = {version})"
                )
