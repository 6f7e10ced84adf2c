"""Incremental loads: new files into the raw layer, micro-batches into the clean layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tiermart.functions import run_timestamp
from tiermart.functions.columns import RunTs
from tiermart.operators.merge import scd1_upsert, scd2_apply
from tiermart.plans.loads import NEWER_BY, clean_segments, clean_source, version_segments
from tiermart.schemas import AUDIT_COLUMNS, UPDATED_TS, Entity, struct
from tiermart.sources.csv import csv_options, file_columns, metadata_key, normalise_nulls
from tiermart.sources.tables import CLEAN, COMMON, CURATED, Layers

# merged batches, and the version of the clean table that each one wrote
BATCHES = struct(
    [("query_id", T.StringType()), ("batch_id", T.LongType()), ("version", T.LongType())]
)


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps over restarts; a new checkpoint has a new one."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def raw_stream(
    spark: SparkSession,
    path: str,
    entity: Entity,
    run_ts: RunTs = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """New files of a folder as raw rows with audit columns.

    Hashing whole files a second time would break the incremental read, so the
    content key is made from file path, size and modification time.
    """
    reader = spark.readStream.schema(entity.source_schema).options(
        **csv_options(entity.multi_line)
    )
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.csv(path).select(*entity.columns, *file_columns(), metadata_key())
    return (
        normalise_nulls(rows, entity.columns)
        .withColumn("_copy_data_ts", run_timestamp(run_ts))
        .select(*entity.columns, *AUDIT_COLUMNS)
    )


def ingest_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived to Parquet at `path`, exactly once."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def upsert_available(
    stream: DataFrame,
    layers: Layers,
    entity: Entity,
    checkpoint: str,
    run_ts: RunTs = None,
    versions: bool = False,
    buckets: int = 0,
) -> StreamingQuery:
    """Merge every micro-batch into the clean table, optionally into versions too.

    A batch starts from the published tables, whoever wrote them, so batch loads and several streams
    may share a table, one writer at a time. A row older than the stored one changes
    nothing. Batches that were merged are recorded with the id of their query: a batch
    repeated after a failure is not merged again; one that failed before its
    record was written finds its own rows there and leaves them as they are.
    The reduced batch is stored first: it feeds several joins, and Spark then knows
    whether it is small enough to leave the target in place. With `buckets`, a batch rewrites only the
    buckets that its rows fall into, and closed versions are appended once.
    """
    done = f"{entity.clean_table}_batches"

    def merge(batch: DataFrame, batch_id: int) -> None:
        query_id = _query_id(layers.spark, checkpoint)
        layers.create_table(COMMON, done, BATCHES)
        this = (F.col("query_id") == query_id) & (F.col("batch_id") == batch_id)
        if not layers.table(COMMON, done).filter(this).isEmpty():
            return
        source = layers.stage(f"batch_{entity.clean_table}", clean_source(batch, entity))
        held = clean_segments(layers, entity, buckets)
        touched = held.touched(source) if buckets else []
        clean = scd1_upsert(
            held.open_rows(touched)
            if buckets
            else layers.table_or_empty(CLEAN, entity.clean_table, entity.clean_schema),
            source,
            entity.key,
            run_ts=run_ts,
            source_unique=True,
            incremental=True,
            newer_by=NEWER_BY,
        )
        if buckets:
            written = held.rewrite(clean, touched)
        else:
            layers.replace(CLEAN, entity.clean_table, clean)
            written = layers.versions(CLEAN, entity.clean_table)[-1]
        if versions:
            # the newest row of each key of the batch, which may be an earlier one
            stored = held.open_rows(touched) if buckets else layers.table(CLEAN, entity.clean_table)
            newest = stored.join(source.select(*entity.key), entity.key, "left_semi").select(
                *entity.typed_columns, UPDATED_TS
            )
            dims = version_segments(layers, entity, buckets)
            if buckets:
                newest = layers.stage(f"newest_{entity.clean_table}", newest)
                changed = dims.touched(newest)
            dim = scd2_apply(
                dims.open_rows(changed)
                if buckets
                else layers.table_or_empty(CURATED, entity.curated_table, entity.curated_schema),
                newest,
                entity.version_key,
                entity.tracked,
                run_ts,
                source_unique=True,
                incremental=True,
            )
            if buckets:
                dims.rewrite(dim, changed)
            else:
                layers.replace(CURATED, entity.curated_table, dim)
        record = [(query_id, batch_id, written)]
        layers.append(COMMON, done, layers.spark.createDataFrame(record, BATCHES))

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

