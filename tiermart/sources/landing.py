"""Append-only tables whose loads are published by a ledger.

The rows of a load land in a partition of their own. The ledger, one row per file, names the loads that
count, and the view of the table's name reads only these. Appending to the ledger is the last step of
a load: before it nobody sees its rows or takes its files for loaded, so a load that failed is
repeated as if it had never begun. One writer at a time per table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermart.sources.tables import COMMON, Layers

LOAD = "_load"
FILE_FIELDS = [
    ("file_name", T.StringType()),
    ("file_size", T.LongType()),
    ("last_modified", T.TimestampNTZType()),
]
LEDGER = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in [
            *FILE_FIELDS,
            ("loaded_at", T.TimestampNTZType()),
            ("load_id", T.StringType()),
        ]
    ]
)


@dataclass(frozen=True)
class Landing:
    layers: Layers
    layer: str
    table: str
    schema: T.StructType

    @property
    def ledger(self) -> str:
        return f"{self.table}_loads"

    @property
    def data(self) -> str:
        return self.layers.data_name(self.table)

    def create(self) -> None:
        """Tables and view, unless they are there; rows of loads that failed are removed."""
        self.layers.create_table(COMMON, self.ledger, LEDGER)
        fields = [*self.schema, T.StructField(LOAD, T.StringType())]
        self.layers.create_table(self.layer, self.data, T.StructType(fields), partition_by=[LOAD])
        spark = self.layers.spark
        if not self.layers.exists(self.layer, self.table):
            columns = ", ".join(f"`{c}`" for c in self.schema.names)
            spark.sql(
                f"CREATE VIEW {self.layers.name(self.layer, self.table)} AS "
                f"SELECT {columns} FROM {self.layers.name(self.layer, self.data)} LEFT SEMI JOIN "
                f"(SELECT DISTINCT load_id FROM {self.layers.name(COMMON, self.ledger)}) AS published "
                f"ON {LOAD} = load_id"
            )
        data = self.layers.name(self.layer, self.data)
        landed = spark.sql(f"SHOW PARTITIONS {data}").select(
            F.split("partition", "=")[1].alias("load_id")
        )
        known = self.layers.table(COMMON, self.ledger)
        for row in landed.join(known, "load_id", "left_anti").collect():  # one per failed load
            spark.sql(f"ALTER TABLE {data} DROP IF EXISTS PARTITION ({LOAD} = '{row.load_id}')")

    def files(self) -> DataFrame:
        """Name, size and modification time of the files that published loads hold."""
        return self.layers.table(COMMON, self.ledger).select(*[name for name, _ in FILE_FIELDS])

    def land(self, rows: DataFrame) -> str:
        """Write rows that nobody sees yet; the id to publish them by."""
        load_id = uuid.uuid4().hex
        placed = rows.select(*self.schema.names, F.lit(load_id).alias(LOAD))
        placed.write.mode("append").insertInto(self.layers.name(self.layer, self.data))
        return load_id

    def publish(self, load_id: str, files: DataFrame) -> None:
        """Make a load count; `files` has at least one row, with loaded_at. Written as one file."""
        entries = files.withColumn("load_id", F.lit(load_id)).select(*LEDGER.names)
        self.layers.append(COMMON, self.ledger, entries.coalesce(1))
