"""Hard negatives: the limits of an anchor's positives divide scores into slots, answers are merged from slots."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermart.llm.common import column, map_batches, ship_package
from tiermart.session import materialise

ANCHORS = 32_768  # anchors of a block, about
ROWS = 16_384  # rows of a chunk, about
PART = 256  # anchors of a block that are scored at a time
EXACT = 2**53  # sums of products below it are exact in double precision

READ = "row long, label string, vec_id long, is_anchor boolean, size int, vector binary"
TOP = "anchor long, slot int, found_id long, score long"


def _scaled(batch: pa.RecordBatch, scale: int) -> pa.RecordBatch:
    """Integer vectors, as doubles; null for a row that takes no part."""
    sizes: list[int | None] = []
    vectors: list[bytes | None] = []
    for values in column(batch, "embedding"):
        vector = None
        if values is not None and not any(v is None for v in values):
            vector = np.floor(scale * np.array(values, dtype=np.float64)) + 0.0
        if vector is None or not np.isfinite(vector).all():
            sizes.append(None)
            vectors.append(None)
        else:
            sizes.append(len(vector))
            vectors.append(vector.tobytes())
    kept = ["row", "label", "vec_id", "is_anchor"]
    arrays = [*batch.select(kept).columns, pa.array(sizes, pa.int32()), pa.array(vectors, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=[*kept, "size", "vector"])


def _matrix(vectors: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(v, dtype=np.float64) for v in vectors])


def _scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products.

    Doubles hold them exactly while their terms stay small; beyond that Python's
    integers do, and a product over 64 bits is an error.
    """
    bound = np.abs(anchors).max(initial=0.0) * np.abs(rows).max(initial=0.0) * anchors.shape[1]
    if bound < EXACT:
        return (anchors @ rows.T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in m], dtype=object) for m in (anchors, rows)]
    products = whole[0] @ whole[1].T
    if max(abs(int(products.max())), abs(int(products.min()))) >= 2**63:
        raise ValueError("an inner product exceeds 64 bits")
    return products.astype(np.int64)


def _first(scores: np.ndarray, where: np.ndarray, best: int) -> np.ndarray:
    """Places of the `best` highest scores among `where`; ties go to the smaller place."""
    found = scores[where]
    if len(where) > best:
        least = np.partition(found, len(where) - best)[len(where) - best]
        where = where[found >= least]
        found = scores[where]
    return where[np.lexsort((where, -found))][:best]


_TOP = pa.schema(
    {"anchor": pa.int64(), "slot": pa.int32(), "found_id": pa.int64(), "score": pa.int64()}
)


def _combiner(best: int, negatives: bool, least: int, most: int):
    """Work on one block of anchors and one chunk of rows: the first `best` rows of every slot.

    For positives there is one slot. For negatives, slot j holds the scores above
    the limit of positive j + 1 and not above that of positive j.
    """

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if anchors.num_rows and rows.num_rows:
            order = rows.sort_by([("vec_id", "ascending"), ("row", "ascending")])
            ids = order.column("vec_id").to_numpy()
            numbers = order.column("row").to_numpy()
            labels, kinds = np.unique(order.column("label").to_pylist(), return_inverse=True)
            known = {label: kind for kind, label in enumerate(labels.tolist())}
            matrix = _matrix(order.column("vector").to_pylist())
            for start in range(0, anchors.num_rows, PART):
                part = anchors.slice(start, PART)
                scores = _scores(_matrix(part.column("vector").to_pylist()), matrix)
                for at, anchor in enumerate(part.drop_columns(["vector"]).to_pylist()):
                    same = kinds == known.get(anchor["label"], -1)
                    found = scores[at]
                    if not negatives:
                        slots = [np.flatnonzero(same & (numbers != anchor["row"]))]
                    else:
                        limits = anchor["limits"]
                        # no window begins below this; those of some limits are empty
                        floors = [
                            -(-least * limit // most) for limit in limits if least * limit <= most * limit
                        ]
                        if not floors:
                            continue
                        open_to = ~same & (found >= min(floors))
                        lower = [*limits[1:], None]
                        slots = [
                            np.flatnonzero(open_to & (found <= high) & (True if low is None else found > low))
                            for high, low in zip(limits, lower)
                        ]
                    for number, where in enumerate(slots, 1):
                        for i in _first(found, where, best).tolist():
                            out.append((anchor["row"], number, int(ids[i]), int(found[i])))
        columns = zip(*out) if out else [[]] * len(_TOP)
        return pa.table([pa.array(c, type=f.type) for c, f in zip(columns, _TOP)], schema=_TOP)

    return run


def _combined(
    anchors: DataFrame, rows: DataFrame, by: list[str], best: int, negatives: bool, least: int, most: int
) -> DataFrame:
    """(anchor, slot, found_id, score): the first `best` of each anchor and slot, over all rows.

    Anchors meet rows of equal `by` columns, in blocks and chunks: a group of either, however
    large, is divided. Every pair of block and chunk keeps what may be among the first, before anything
    is shuffled again.
    """
    session = rows.sparkSession

    def parts(frame: DataFrame, size: int, name: str) -> DataFrame:
        counted = frame.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))
        return materialise(counted, name)

    blocks, chunks = parts(anchors, ANCHORS, "blocks"), parts(rows, ROWS, "chunks")
    both = blocks.join(chunks, by)
    each = F.pmod(F.xxhash64("row", F.lit(5)), F.col("blocks")).cast("int")
    left = (
        anchors.join(both, by)
        .withColumn("block", each)
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .drop("blocks", "chunks")
    )
    each = F.pmod(F.xxhash64("row", F.lit(9)), F.col("chunks")).cast("int")
    right = (
        rows.join(both, by)
        .withColumn("chunk", each)
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .drop("blocks", "chunks")
    )
    keys = [*by, "block", "chunk"]
    ship_package(session)
    found = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(_combiner(best, negatives, least, most), TOP)
    )
    first = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "found_id")
    return (
        found.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= best).drop("nth")
    )


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    most: int = 100,
    scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of rows(vec_id, embedding, label).

    Scores are inner products of integer vectors, each component times `scale` and rounded down. An anchor's
    positives are the first `positives` other rows of its label, higher scores first, then smaller ids. For each
    of them come the first `negatives` rows of other labels with
    least * positive_score <= most * negative_score <= most * positive_score.

    The scores of an anchor's positives, in descending order, divide the scores of all other rows into disjoint
    slots. Each group of anchors and rows keeps the first `negatives` rows of every slot only, and these are
    combined per slot. The windows of all positives are then read from suffixes of the slots: positive j takes
    slots j and below, whose first rows are the first below its limit, and the lower
    limit ends them.

    Rows with a null id, label or vector, or a null or non-finite component, take no part, and rows with
    different numbers of components do not meet. A row that repeats an id is a row of its own, for an anchor
    as well. A positive with a score below 0 has an empty window. Other columns
    are ignored; an empty table gives no rows.
    """
    numbered = materialise(
        rows.select(
            F.col("vec_id").cast("long"),
            "embedding",
            F.col("label").cast("string"),
            F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        )
        .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull())
        .withColumn("row", F.monotonically_increasing_id()),
        "rows",
    )
    vectors = map_batches(numbered, lambda batch: _scaled(batch, scale), READ)
    usable = materialise(vectors.where(F.col("vector").isNotNull()), "vectors")
    anchors = materialise(usable.where("is_anchor").drop("is_anchor"), "anchors")
    usable = usable.drop("is_anchor")

    near = materialise(
        _combined(anchors, usable, ["size", "label"], positives, False, least, most), "positives"
    )
    limits = near.groupBy(F.col("anchor").alias("row")).agg(
        F.sort_array(F.collect_list("score"), asc=False).alias("limits")
    )
    wanted = materialise(anchors.join(limits, "row"), "limits")
    slots = _combined(wanted, usable, ["size"], negatives, True, least, most)
    # at most positives * negatives rows an anchor
    slot = F.struct(
        (-F.col("score")).alias("down"), F.col("found_id").alias("id"), "slot", "score"
    )
    listed = slots.groupBy("anchor").agg(F.array_sort(F.collect_list(slot)).alias("found"))
    place = Window.partitionBy("anchor").orderBy(F.desc("score"), "found_id")
    suffix = F.slice(F.filter("found", lambda x: x["slot"] >= F.col("positive")), 1, negatives)
    within = F.filter(
        suffix, lambda x: F.lit(least) * F.col("positive_score") <= F.lit(most) * x["score"]
    )
    return (
        near.select(
            "anchor",
            F.row_number().over(place).alias("positive"),
            F.col("found_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        )
        .join(listed, "anchor")
        .join(anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", "positive_score", F.posexplode(within).alias("nth", "one"))
        .select(
            "anchor_id",
            "positive_id",
            (F.col("nth") + 1).alias("rank"),
            F.col("one.id").alias("negative_id"),
            "positive_score",
            F.col("one.score").alias("negative_score"),
        )
    )

