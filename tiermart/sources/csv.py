"""Delimited files: reading into the raw layer and writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermart.functions import run_timestamp
from tiermart.functions.columns import RunTs, instant_in_zone
from tiermart.operators.skew import divided_join, is_broadcast
from tiermart.schemas import AUDIT_COLUMNS, Entity
from tiermart.session import materialise
from tiermart.sources.files import content_keys
from tiermart.sources.quoted import quoted_records

# The file format.
NULL_TOKENS = ["NULL", "null", "\\N"]
CSV_OPTIONS = {
    "sep": ",",
    # names come from the declared schema, by position; the header is skipped
    "enforceSchema": "true",
    "quote": '"',
    "escape": '"',
    # one token can be named here; it also keeps a quoted empty field apart
    # from an unquoted one
    "nullValue": "NULL",
    # a ragged line must fail even if the query does not read its columns
    "columnPruning": "false",
}
CORRUPT = "_corrupt_record"


def csv_options(
    multi_line: bool = True, mode: str = "FAILFAST", header: bool = True
) -> dict[str, str]:
    """Reader options; compressed files are recognised by their extension."""
    return {
        **CSV_OPTIONS,
        "multiLine": str(multi_line).lower(),
        "mode": mode,
        "header": str(header).lower(),
    }


def null_tokens_to_null(value: Column) -> Column:
    return F.when(value.isin(*NULL_TOKENS), None).otherwise(value)


def normalise_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """Turn every null token of the listed text columns into NULL."""
    return df.withColumns({c: null_tokens_to_null(F.col(c)) for c in columns})


def scan_csv(
    spark: SparkSession, path: str | list[str], entity: Entity, header: bool = True
) -> DataFrame:
    """Columns of the file by position, all text, null tokens as NULL."""
    df = (
        spark.read.schema(entity.source_schema)
        .options(**csv_options(entity.multi_line, header=header))
        .csv(path)
    )
    return normalise_nulls(df, entity.columns)


def scan_typed(
    spark: SparkSession, path: str | list[str], entity: Entity, columns: list[str]
) -> DataFrame:
    """Preview of a file with some columns cast while reading."""
    kinds = dict(entity.fields)
    return scan_csv(spark, path, entity).withColumns(
        {c: F.col(c).cast(kinds[c]) for c in columns}
    )


def scan_quoted(
    spark: SparkSession, path: str | list[str], entity: Entity, header: bool = True
) -> DataFrame:
    """As `scan_csv` and with the columns of the file, for quoted fields that hold line breaks.

    A large file is read by several tasks. Any ragged record aborts.
    """
    options = csv_options(multi_line=False, header=False)
    parsed = quoted_records(spark, path, header).select(
        F.from_csv("record", F.lit(entity.source_schema.simpleString()[7:-1].replace(":", " ")), options).alias("row"),
        F.col("file").alias("_stg_file_name"),
        instant_in_zone(F.col("modified")).alias("_stg_file_load_ts"),
        metadata_key("file", "size", "modified"),
    )
    return normalise_nulls(
        parsed.select("row.*", "_stg_file_name", "_stg_file_load_ts", "_stg_file_md5"), entity.columns
    )


def file_columns() -> list[Column]:
    """File name and modification time of each row, for any file scan."""
    return [
        F.col("_metadata.file_path").alias("_stg_file_name"),
        instant_in_zone(F.col("_metadata.file_modification_time")).alias("_stg_file_load_ts"),
    ]


def metadata_key(
    path: str = "_metadata.file_path",
    size: str = "_metadata.file_size",
    modified: str = "_metadata.file_modification_time",
) -> Column:
    """MD5 of path, size and modification time: needs no second look at the file."""
    stamp = F.concat_ws("|", path, size, F.unix_micros(modified))
    return F.md5(stamp).alias("_stg_file_md5")


def with_audit(
    spark: SparkSession,
    scan: DataFrame,
    path: str | list[str],
    entity: Entity,
    run_ts: RunTs = None,
    hash_content: bool = True,
) -> DataFrame:
    """Add file name, modification time, content key and load time.

    Hashing the content reads every file twice. Without `hash_content` the key
    is made from the file's metadata and the files are read once. A scan that has the file's columns
    already keeps them.
    """
    if "_stg_file_name" not in scan.columns:
        scan = scan.select(*entity.columns, *file_columns(), metadata_key())
    if not hash_content:
        return scan.withColumn("_copy_data_ts", run_timestamp(run_ts)).select(
            *entity.columns, *AUDIT_COLUMNS
        )
    rows = scan.drop("_stg_file_md5")
    # stored, so that Spark knows the size of one row per file
    keys = materialise(content_keys(spark, path), "file-keys").select(
        F.col("file_name").alias("_stg_file_name"), F.col("content_key").alias("_stg_file_md5")
    )
    # rows do not move if the keys are broadcast, so the files are not read once more to find those that hold
    # most rows; otherwise such files are divided
    if is_broadcast(keys):
        found = rows.join(keys, "_stg_file_name", "left")
    else:
        found = divided_join(rows, keys, ["_stg_file_name"], "left")
    return (
        found.withColumn("_copy_data_ts", run_timestamp(run_ts))
        .select(*entity.columns, *AUDIT_COLUMNS)
    )


def read_raw(
    spark: SparkSession,
    path: str | list[str],
    entity: Entity,
    run_ts: RunTs = None,
    hash_content: bool = True,
) -> DataFrame:
    """Rows for the raw table of an entity; any malformed line aborts."""
    scan = (scan_quoted if entity.multi_line else scan_csv)(spark, path, entity)
    return with_audit(spark, scan, path, entity, run_ts, hash_content)


def read_or_quarantine(
    spark: SparkSession, path: str | list[str], entity: Entity, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Split a scan into (well-formed rows, malformed lines with file name).

    A malformed line that the parser does not return is shown as its fields.
    """
    schema = T.StructType([*entity.source_schema, T.StructField(CORRUPT, T.StringType())])
    df = (
        spark.read.schema(schema)
        .options(**csv_options(entity.multi_line, "PERMISSIVE", header))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    good = df.filter(F.col(CORRUPT).isNull()).select(*entity.columns, *file_columns())
    line = F.coalesce(F.col(CORRUPT), F.concat_ws(",", *entity.columns))
    bad = df.filter(F.col(CORRUPT).isNotNull()).select(
        line.alias(CORRUPT), F.col("_metadata.file_path").alias("_stg_file_name")
    )
    return normalise_nulls(good, entity.columns), bad


def write_csv(
    df: DataFrame, path: str, mode: str = "errorifexists", compression: str = "none"
) -> None:
    """One header line per file; NULL as an unquoted empty field.

    Files written with `compression` "gzip" take less than half the disk, but each is read by one task.
    """
    df.write.mode(mode).options(
        **{"sep": ",", "header": "true", "quote": '"', "escape": '"', "nullValue": "", "emptyValue": '""'},
        **{"compression": compression, "zlib.compress.level": "BEST_SPEED"},
    ).csv(path)
