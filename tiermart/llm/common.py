"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tiermart

# white space between words: the byte classes of the contract, \x20 and \x09-\x0D
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def words_of(text: str) -> list[bytes]:
    """The words of a text as UTF-8; `bytes.split` divides at exactly SPACES."""
    return text.encode("utf-8", "surrogatepass").split()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, which need not have it installed.

    Spark serves the archive from the driver, once per application.
    """
    application = spark.sparkContext.applicationId
    package = Path(tiermart.__file__).parent
    if application in _SHIPPED or not package.is_dir():
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as file:
        for module in sorted(package.rglob("*.py")):
            file.write(module, module.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(application)


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """Apply a function to every Arrow batch; it may return None for no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            result = function(batch)
            if result is not None and result.num_rows:
                yield result

    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, size: str = "2m") -> Iterator[None]:
    """Send rows to Python in batches of a few megabytes while operators that move whole texts run.

    A task holds a batch several times, in the JVM and in Python; the usual size is bound by a number of rows,
    whatever their length. A batch holds at least one row. Only for steps that are stored before the end.
    """
    before = spark.conf.get(BATCH_BYTES, None)
    spark.conf.set(BATCH_BYTES, size)
    try:
        yield
    finally:
        spark.conf.unset(BATCH_BYTES) if before is None else spark.conf.set(BATCH_BYTES, before)


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; a null text is an empty one."""
    return [text or "" for text in column(batch, name)]


def labelled_once(labels: DataFrame) -> DataFrame:
    """(doc_id, label) of labels(doc_id, quality), one row per document.

    Rows without id or label are left out. Several labels of one document count
    as 1 if at least half of them are 1.
    """
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg((F.avg(F.col("quality").cast("double")) >= 0.5).cast("int").alias("label"))
    )


def labelled_sample(labels: DataFrame, bound: int) -> DataFrame:
    """At most `bound` rows of `labelled_once`.

    Which rows are taken depends on a hash of the id alone. The bound makes the result small enough to broadcast.
    """
    once = labelled_once(labels)
    return once.orderBy(F.xxhash64(F.col("doc_id"), F.lit(7)), "doc_id").limit(bound)


def labelled_documents(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """(doc_id, text, label) of the documents in a bounded sample of labelled rows."""
    sample = labelled_sample(labels, bound)
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
