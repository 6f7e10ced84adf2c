"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Every operator assumes these. All are runtime settings, so `configure` also
# works on a session somebody else built.
OPERATOR_CONF = {
    # a value that does not fit its declared type aborts the load
    "spark.sql.ansi.enabled": "true",
    # runtime broadcast, partition coalescing and splitting of hot partitions;
    # the split is wanted even where it costs one more exchange
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # what a task sorts or joins at once follows these sizes, not the input: tables are read in small
    # splits, and shuffles begin with many partitions (below), put together up to the advisory size
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    # shuffle files go when the query that wrote them has ended, not when the driver happens to collect its
    # garbage: loads are many queries, and those before need no disk while the next one runs
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # every layer keeps the rows once more; keys and prices take about 60 % of their size with the default
    "spark.sql.parquet.compression.codec": "zstd",
    # data already placed by order_id also serves joins on (order_id, product_id)
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # unions of differently partitioned branches fail to plan otherwise when
    # versioning passes are chained
    "spark.sql.unionOutputPartitioning": "false",
}

# Partitions that a shuffle begins with, unless the session asks for more.
FIRST_PARTITIONS = 500
_FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to an existing session."""
    for key, value in OPERATOR_CONF.items():
        spark.conf.set(key, value)
    asked = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(_FIRST, str(max(asked, FIRST_PARTITIONS)))
    return spark


def build_session(
    app_name: str = "tiermart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the operator settings; `master` only for local runs."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.host", "127.0.0.1").config(
                "spark.driver.bindAddress", "127.0.0.1"
            )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    first = {_FIRST: str(max(shuffle_partitions or 0, FIRST_PARTITIONS))}
    for key, value in {**OPERATOR_CONF, **first, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_DIRS: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    Local sessions that name none (tests) get a fresh temporary folder, kept
    for the rest of the session. A cluster session that names none is an error:
    a folder of one machine would lose data with that machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    application = spark.sparkContext.applicationId
    if application in _LOCAL_DIRS:
        return _LOCAL_DIRS[application]
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    _LOCAL_DIRS[application] = tempfile.mkdtemp(prefix="tiermart-")
    return _LOCAL_DIRS[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the working folder that no other run uses."""
    return os.path.join(work_dir(spark), f"{name}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back.

    Cuts the plan, survives lost executors, and gives Spark the true size of
    the data for its join choices.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
