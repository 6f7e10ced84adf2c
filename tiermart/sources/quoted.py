"""Delimited files whose quoted fields hold line breaks, read by as many tasks as they have blocks.

A line break ends a record only outside quotes, so what a line is depends on all quotes before it. A first pass
counts the quotes of every block of a file; running sums of these few numbers tell which blocks begin inside a
field. The second pass then cuts each block into records on its own, and the pieces of the records that
cross a border are put together, one or two for each block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# of each line: its file and block, and what audit columns are made of
_PLACE = "file string, block long, size long, modified timestamp"
RECORDS = f"{_PLACE}, kind int, record string"
# a record, the end of one, the beginning of one, and the beginning of a file's header
WHOLE, HEAD, TAIL, HEADER = 0, 1, 2, 3


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
    )


def _inside(lines: DataFrame, quote: str) -> DataFrame:
    """(file, block) of the blocks that begin inside a quoted field; one row per block is summed."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    counted = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return (
        counted.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
        .where("inside = 1")
        .select("file", "block", "inside")
    )


def _cut(header: bool, quote: str):
    """Records of the lines of each block, which arrive in order."""
    kinds = (WHOLE, HEAD, TAIL, HEADER)
    schema = pa.schema(
        {
            "file": pa.string(), "block": pa.int64(), "size": pa.int64(),
            "modified": pa.timestamp("us", "UTC"), "kind": pa.int32(), "record": pa.string(),
        }
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, head, tail, heading = kinds
        place = None  # the present block
        place_of = None  # its columns of each record
        waiting: list[str] = []  # lines of the record that is not ended yet
        started = False  # whether a record has begun in this block
        first = False  # whether the next record is the first of a file

        def emitted(kind: int, records: list[str]) -> pa.RecordBatch:
            n = len(records)
            columns = [pa.array([v] * n, f.type) for v, f in zip(place_of, schema)]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array([kind] * n, pa.int32()), pa.array(records, pa.string())], schema=schema
            )

        def ended() -> Iterator[pa.RecordBatch]:
            """What is left of a block whose last record does not end in it."""
            if waiting:
                kind = head if not started else heading if first else tail
                yield emitted(kind, ["\n".join(waiting)])

        for batch in batches:
            files, blocks = batch.column("file"), batch.column("block").to_numpy()
            values, inside = batch.column("value"), batch.column("inside").to_numpy()
            odd = pc.count_substring(values, quote).to_numpy() % 2
            names = np.asarray(files.to_pylist(), dtype=object)
            changes = np.flatnonzero((blocks[1:] != blocks[:-1]) | (names[1:] != names[:-1])) + 1
            for start, stop in zip([0, *changes.tolist()], [*changes.tolist(), len(blocks)]):
                if start == stop:
                    continue
                here = names[start], int(blocks[start])
                if here != place:
                    if place is not None:
                        yield from ended()
                    place, waiting = here, []
                    place_of = (
                        *here, batch.column("size")[start].as_py(), batch.column("modified")[start].as_py()
                    )
                    started = not inside[start]
                    first = header and here[1] == 0
                    state = int(inside[start])
                # whether each line ends inside a field
                after = (state + np.cumsum(odd[start:stop])) % 2
                state = int(after[-1])
                lines = values.slice(start, stop - start)
                ends = np.flatnonzero(after == 0) + 1  # lines after which a record ends
                if not len(ends):
                    waiting += lines.to_pylist()
                    continue
                offsets = pa.array(np.append(0, ends), pa.int32())
                joined = pc.binary_join(pa.ListArray.from_arrays(offsets, lines.slice(0, int(ends[-1]))), "\n")
                records = joined.to_pylist()
                if waiting:
                    records[0] = "\n".join([*waiting, records[0]])
                waiting = lines.slice(int(ends[-1])).to_pylist()
                if not started:
                    yield emitted(head, records[:1])
                    records, started = records[1:], True
                if first and records:
                    records, first = records[1:], False
                if records:
                    yield emitted(whole, records)
        if place is not None:
            yield from ended()

    return run


def quoted_records(
    spark: SparkSession, path: str | list[str], header: bool = True, quote: str = '"'
) -> DataFrame:
    """(file, size, modified, record): the text of every record, without its line end.

    Lines end with a line feed, with or without a carriage return before; every quote counts, so a field that
    holds quotes must be quoted itself, its quotes doubled. The first record of a file is left out with
    `header`; empty records are none. A field that is still open at the end of a file ends there.
    Compressed files cannot be divided and are one block each.
    """
    # one small row per block at most, so it is sent to all tasks: no line moves, and all stay in the order of
    # their file, which a join of both sides would lose and a task would have to sort for
    known = F.broadcast(_inside(_lines(spark, path), quote))
    placed = (
        _lines(spark, path)
        .join(known, ["file", "block"], "left")
        .withColumn("inside", F.coalesce("inside", F.lit(0)).cast("int"))
        .select("file", "block", "size", "modified", "value", "inside")
    )
    cut = placed.mapInArrow(_cut(header, quote), RECORDS)
    whole = cut.where(F.col("kind") == WHOLE).select("file", "size", "modified", "record")
    # a tail begins a record; heads, and blocks that lie within one record, go on with it
    order = Window.partitionBy("file").orderBy("block", "kind")
    piece = F.struct("block", "kind", "record")
    crossing = (
        cut.where(F.col("kind") != WHOLE)
        .withColumn("nth", F.sum((F.col("kind") >= TAIL).cast("int")).over(order))
        .groupBy("file", "size", "modified", "nth")
        .agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
        .where(F.col("pieces")[0]["kind"] != HEADER)
        .withColumn("record", F.array_join(F.col("pieces.record"), "\n"))
    )
    record = F.regexp_replace(F.regexp_replace("record", "\r$", ""), "^\ufeff", "")
    return (
        whole.union(crossing.select("file", "size", "modified", "record"))
        .withColumn("record", record)
        .where(F.col("record") != "")
    )
