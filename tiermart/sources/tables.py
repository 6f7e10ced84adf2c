"""Layer namespaces and their tables, on whatever catalog the session has.

Plain Parquet tables have no row-level updates and cannot be overwritten while
they are read. A table that is replaced is therefore written as a new version
`<table>__v<n>` and published by pointing the view `<table>` at it; readers of
the previous version are not disturbed, and a failed write publishes nothing.
Large tables of facts can be kept as a log instead, to which a load only appends. Tables of which
a load rewrites only some buckets are in `sources.segments`, raw tables in `sources.landing`.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of the layers.
RAW, CLEAN, CURATED, COMMON = "bronze_sch", "silver_sch", "gold_sch", "common_sch"
LAYERS = [RAW, CLEAN, CURATED, COMMON]


class Layers:
    """Tables of the layers. `prefix` separates several warehouses of one catalog."""

    def __init__(self, spark: SparkSession, prefix: str = "", location: str | None = None):
        self.spark = spark
        self.prefix = prefix
        self.location = location

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.database(layer)}.{table}"

    def create(self) -> None:
        for layer in LAYERS:
            place = f" LOCATION '{self.location}/{layer}'" if self.location else ""
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(layer)}{place}")

    def drop_all(self) -> None:
        for layer in LAYERS:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.database(layer)} CASCADE")

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def table_or_empty(self, layer: str, table: str, schema: T.StructType) -> DataFrame:
        """The table, or no rows of its schema before the first load."""
        if self.exists(layer, table):
            return self.table(layer, table)
        return self.spark.createDataFrame([], schema)

    def create_table(
        self, layer: str, table: str, schema: T.StructType, partition_by: Sequence[str] = ()
    ) -> None:
        """Create an appendable table unless it is there already."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(layer, table)} ({columns}) USING parquet{parts}"
        )

    def data_name(self, table: str) -> str:
        """The table that holds the rows of a view which shows only some of them."""
        return f"{table}__data"

    def append(self, layer: str, table: str, df: DataFrame) -> None:
        self.create_table(layer, table, df.schema)
        df.write.mode("append").format("parquet").saveAsTable(self.name(layer, table))

    def drop(self, layer: str, table: str) -> None:
        """Drop a table, with its versions, its log or its data, if present."""
        versions = self.versions(layer, table)
        log, data = self.log_name(layer, table), self.data_name(table)
        if self.exists(layer, data):
            self.spark.sql(f"DROP VIEW IF EXISTS {self.name(layer, table)}")
            self.spark.sql(f"DROP TABLE {self.name(layer, data)}")
        elif self.exists(layer, log):
            self.spark.sql(f"DROP VIEW IF EXISTS {self.name(layer, table)}")
            self.spark.sql(f"DROP TABLE {self.name(layer, log)}")
        elif versions:
            self.spark.sql(f"DROP VIEW IF EXISTS {self.name(layer, table)}")
            for v in versions:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.version_name(layer, table, v)}")
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, table)}")

    def version_name(self, layer: str, table: str, version: int) -> str:
        return f"{self.name(layer, table)}__v{version}"

    def versions(self, layer: str, table: str) -> list[int]:
        found = self.spark.catalog.listTables(self.database(layer), f"{table}__v*")
        return sorted(int(t.name.rsplit("__v", 1)[1]) for t in found)

    def replace(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        version: int | None = None,
        bucket_by: Sequence[str] = (),
        buckets: int = 0,
        keep: int = 2,
        further: Iterable[DataFrame] = (),
    ) -> None:
        """Write `df` as the next version and publish it.

        Rows of `further` are added to it one after the other, so that only one at a time takes disk for its
        shuffles; they are published together.

        `df` may read the published version. With `buckets` the rows are stored
        by hash of `bucket_by`: the next merge on those columns, and joins
        between tables bucketed alike, then need no shuffle of this table.
        A given `version` makes a repeated write land in the same place.
        """
        before = self.versions(layer, table)
        if version is None:
            version = before[-1] + 1 if before else 0
        target = self.version_name(layer, table, version)
        writer = df.write.mode("overwrite").format("parquet")
        if buckets:
            writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
        writer.saveAsTable(target)
        for rows in further:
            rows.write.insertInto(target)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(layer, table)} AS SELECT * FROM {target}"
        )
        for old in [v for v in before if v <= version - keep]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.version_name(layer, table, old)}")

    def append_latest(
        self, layer: str, table: str, df: DataFrame, keys: Sequence[str], order: Sequence[str]
    ) -> None:
        """Append rows to the log of a table whose view shows the latest row per key.

        The latest is the one with the largest `order`, NULL being the smallest; all other columns
        decide between equal ones. Nothing that is stored already is read or written
        again.
        """
        log = self.log_name(layer, table)
        self.append(layer, log, df)
        columns, by_key = ", ".join(df.columns), ", ".join(keys)
        rest = [c for c in df.columns if c not in keys and c not in order]
        latest = ", ".join(f"{c} DESC NULLS LAST" for c in [*order, *rest])
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(layer, table)} AS SELECT {columns} FROM ("
            f"SELECT *, row_number() OVER (PARTITION BY {by_key} ORDER BY {latest}) AS nth "
            f"FROM {self.name(layer, log)}) AS log WHERE nth = 1"
        )

    def log_name(self, layer: str, table: str) -> str:
        return f"{table}__log"

    def changes(self, layer: str, table: str, order: str, since: Column) -> DataFrame:
        """Rows of a table written at or after `since`; of a log, only those are read."""
        log = self.log_name(layer, table)
        if self.exists(layer, log):
            return self.table(layer, log).filter(F.col(order) >= since)
        return self.table(layer, table).filter(F.col(order) >= since)

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """Store an intermediate result until the next of that name and read it back.

        The stored rows feed several joins without being computed again, and
        Spark knows their true size when it picks a join.
        """
        self.replace(COMMON, name, df, keep=1)
        return self.spark.table(self.version_name(COMMON, name, self.versions(COMMON, name)[-1]))
