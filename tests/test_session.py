"""Tasks hold what the settings allow, whatever the size of the input and the session's own settings."""

import time

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tiermart.session import FIRST_PARTITIONS, configure


def test_shuffles_are_divided_by_size(spark, conf):
    conf(
        shuffle__partitions=2,
        adaptive__coalescePartitions__initialPartitionNum=2,
        adaptive__advisoryPartitionSizeInBytes="32m",
    )
    configure(spark)
    conf(adaptive__advisoryPartitionSizeInBytes="64KB", adaptive__coalescePartitions__minPartitionSize="16KB")
    rows = spark.range(200_000).select("id", F.md5(F.col("id").cast("string")).alias("text"))
    tasks = rows.repartition("id").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(tasks) > 20 and sum(t["count"] for t in tasks) == 200_000


def test_a_session_that_asks_for_more_partitions_gets_them(spark, conf):
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    conf(shuffle__partitions=4, adaptive__coalescePartitions__initialPartitionNum=4)
    assert configure(spark).conf.get(first) == str(FIRST_PARTITIONS)
    conf(shuffle__partitions=FIRST_PARTITIONS + 7)
    assert configure(spark).conf.get(first) == str(FIRST_PARTITIONS + 7)


def test_files_are_read_in_small_splits(spark, conf, tmp_path):
    conf(files__maxPartitionBytes="128m", files__minPartitionNum=1)
    path = tmp_path / "lines.txt"
    path.write_text(("x" * 99 + "\n") * 400_000)
    assert configure(spark).read.text(str(path)).rdd.getNumPartitions() == 3


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {name for name in names if name.startswith("shuffle_")}


def test_shuffle_files_go_when_their_query_has_ended(spark, tmp_path):
    before = _shuffle_files(spark)
    rows = configure(spark).range(50_000).repartition(7, "id")
    rows.write.parquet(str(tmp_path / "written"))
    rows.write.saveAsTable("left_no_shuffles", path=str(tmp_path / "table"))
    spark.sql("DROP TABLE left_no_shuffles")
    until = time.time() + 15
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert rows.count() == 50_000  # and can be computed again


def test_stored_tables_are_compressed_by_zstd(spark, tmp_path):
    configure(spark).range(1000).write.parquet(str(tmp_path / "written"))
    files = list((tmp_path / "written").glob("*.parquet"))
    assert {pq.read_metadata(f).row_group(0).column(0).compression for f in files} == {"ZSTD"}
