"""Directories of files: listing, content keys, removal."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiermart.functions.columns import instant_in_zone


def _files(spark: SparkSession, path: str | list[str], pattern: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def list_files(
    spark: SparkSession, path: str | list[str], pattern: str | None = None
) -> DataFrame:
    """One row per file: path, size in bytes, modification time. Reads no content."""
    return _files(spark, path, pattern).select(
        F.col("path").alias("file_name"),
        F.col("length").alias("file_size"),
        instant_in_zone(F.col("modificationTime")).alias("last_modified"),
    )


def remove_files(spark: SparkSession, names: Iterable[str]) -> None:
    """Remove files, given as `list_files` names them; one that is gone already is no error."""
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, False)


def content_keys(
    spark: SparkSession, path: str | list[str], pattern: str | None = None
) -> DataFrame:
    """One row per file with lines: `file_name` and an MD5 `content_key`.

    The key is made from the size of the file, the number of its lines, and four sums over the MD5 of each
    line: of its two halves, and of these times the line's number in the file. Files with other lines, in another
    order or with other line ends have other keys. Sums are made per block of a file, with lines numbered within the
    block, and shifted by the lines of the blocks before: a file of any size is read once, in
    parts, and only one row per block is brought together.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n")
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    digest = F.md5("value")

    def part(start: int) -> Column:
        return F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(20,0)")

    def total(value: Column) -> Column:
        return F.sum(value).cast("decimal(38,0)")

    # the number of a line among those that its task reads; a block is read by one task
    nth = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    lines = reader.text(path).select(
        F.col("_metadata.file_path").alias("file_name"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"),
        part(1).alias("one"),
        part(16).alias("two"),
        nth.cast("decimal(11,0)").alias("nth"),
    )
    halves = ["one", "two"]
    blocks = lines.groupBy("file_name", "size", "block").agg(
        F.count(F.lit(1)).alias("lines"),
        F.min("nth").alias("first"),
        *[total(F.col(h)).alias(h) for h in halves],
        *[total(F.col(h) * F.col("nth")).alias(f"{h}_at") for h in halves],
    )
    earlier = Window.partitionBy("file_name").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shift = F.coalesce(F.sum("lines").over(earlier), F.lit(0)) - F.col("first")
    placed = blocks.withColumn("shift", shift.cast("decimal(15,0)"))
    sums = [
        *[total(F.col(h)).alias(h) for h in halves],
        *[total(F.col(f"{h}_at") + (F.col(h) * F.col("shift")).cast("decimal(38,0)")).alias(f"{h}_at") for h in halves],
    ]
    return (
        placed.groupBy("file_name", "size")
        .agg(F.sum("lines").alias("lines"), *sums)
        .select(
            "file_name",
            F.md5(F.concat_ws("|", "size", "lines", "one", "two", "one_at", "two_at")).alias("content_key"),
        )
    )
