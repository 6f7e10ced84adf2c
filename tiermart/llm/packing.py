"""Best-fit packing of token sequences, planned on the histogram of lengths."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiermart.llm.common import column, map_batches, texts_of
from tiermart.session import materialise

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLAN = "length long, first long, last long, per_sequence long, sequence long, offset long"

# the two libraries give equal ids (tests/llm/test_packing.py) on Latin, Greek and
# Cyrillic text and its signs; other scripts depend on the Unicode version of their patterns
SAME_IDS = [(0, 0x52F), (0x1E00, 0x1EFF), (0x2000, 0x206F), (0x20A0, 0x20BF), (0x2100, 0x214F)]
OTHER_SCRIPTS = re.compile("[^" + "".join(f"{chr(a)}-{chr(b)}" for a, b in SAME_IDS) + "]")


class ByteTokenizer:
    """Ids of a byte-level vocabulary, as `tokenizers` gives them.

    With a rank file of the same vocabulary, ordinary texts take the faster `tiktoken`;
    texts of other scripts and texts that hold a special token take `tokenizers`.
    """

    def __init__(self, path: str, ranks: str | None = None) -> None:
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.special = [
            token.content for token in self.exact.get_added_tokens_decoder().values()
        ]
        self.quick = _ranked(ranks) if ranks else None

    def encode(self, text: str) -> np.ndarray:
        if (
            self.quick is None
            or (not text.isascii() and OTHER_SCRIPTS.search(text))
            or any(token in text for token in self.special)
        ):
            ids = self.exact.encode(text, add_special_tokens=False).ids
            return np.array(ids, dtype=np.uint32)
        return self.quick.encode_to_numpy(text, disallowed_special=()).astype(np.uint32)


def _ranked(path: str):
    import base64

    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file)}
    return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


_TOKENIZERS: dict[tuple[str, str | None], ByteTokenizer] = {}


def _tokenizer(path: str, ranks: str | None) -> ByteTokenizer:
    """One per worker process."""
    if (path, ranks) not in _TOKENIZERS:
        _TOKENIZERS[path, ranks] = ByteTokenizer(path, ranks)
    return _TOKENIZERS[path, ranks]


def token_pieces(
    docs: DataFrame, path: str, ranks: str | None = None, capacity: int = 2048, end_id: int = 0
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of docs(doc_id, text).

    A document is the ids of its text and an end id. One longer than `capacity` is cut;
    all its pieces are full except perhaps the first. A null or empty text is the end
    id alone. Every row is a document of its own, also one that repeats an id
    or has none; other columns are ignored.
    """

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode = _tokenizer(path, ranks).encode
        rows: list[tuple] = []
        for doc_id, text in zip(column(batch, "doc_id"), texts_of(batch)):
            ids = np.append(encode(text), np.uint32(end_id)).astype("<u4")
            start, stop = 0, len(ids) % capacity or capacity
            piece = 0
            while start < len(ids):
                crc = zlib.crc32(ids[start:stop].tobytes())
                rows.append((doc_id, piece, start, stop - start, crc))
                start, stop, piece = stop, stop + capacity, piece + 1
        values = zip(*rows)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        return pa.RecordBatch.from_arrays(
            [pa.array(v, type=k) for v, k in zip(values, kinds)], names=names
        )

    return map_batches(
        docs.select(F.col("doc_id").cast("long"), "text"),
        lambda batch: cut(batch) if batch.num_rows else None,
        PIECES,
    )


@dataclass(frozen=True, order=True)
class Bins:
    """Sequences numbered from `first` whose contents end at the same place."""

    first: int
    count: int


def plan_best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, ...]]:
    """Runs (length, first rank, last rank, per sequence, first sequence, offset).

    Takes lengths from the longest to the shortest and puts each item into the fullest
    open sequence that still has room, many equal items and equal sequences at a time. Item
    `rank` of a run goes to sequence `first sequence + (rank - first rank) // per sequence`.

    The size of the plan does not depend on the number of items: a length adds at most
    three ranges of equal sequences, and a range takes part in at most one run
    for each distinct length in it, of which fewer than sqrt(2 * capacity) fit.
    """
    room: dict[int, list[Bins]] = {}
    sizes: list[int] = []  # the keys of `room`, ascending
    runs: list[tuple[int, ...]] = []
    total = 0

    def put(left: int, bins: Bins) -> None:
        if left and bins.count:
            if left not in room:
                room[left] = []
                insort(sizes, left)
            room[left].append(bins)

    for length in sorted(counts, reverse=True):
        items, rank = counts[length], 0
        while items:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                left = sizes[at]
                bins = room[left].pop()
                if not room[left]:
                    del room[left], sizes[at]
                each = left // length
            else:
                left, each = capacity, capacity // length
                bins = Bins(total, -(-items // each))
                total += bins.count
            offset = capacity - left
            full = min(bins.count, items // each)
            if full:
                runs.append((length, rank, rank + full * each - 1, each, bins.first, offset))
                rank, items = rank + full * each, items - full * each
                put(left - each * length, Bins(bins.first, full))
            rest = Bins(bins.first + full, bins.count - full)
            if items and rest.count:  # fewer items than fit into one sequence
                runs.append((length, rank, rank + items - 1, items, rest.first, offset))
                put(left - items * length, Bins(rest.first, 1))
                rest, items = Bins(rest.first + 1, rest.count - 1), 0
            put(left, rest)
    return runs


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add (sequence_id, offset) to pieces(doc_id, piece, start, length, ids_crc32).

    The histogram of lengths, at most `capacity` numbers, is all that reaches the driver. A
    piece takes the slot of its rank within its length. Ranks come from counts per length and
    shard, so that a length which very many documents share is divided as well: shard
    offsets are running sums of these counts, and a window numbers
    the rows of one length and shard. Repeated rows get a slot each. A length under
    1 or above `capacity` is an error; no rows give no rows.
    """
    spark = pieces.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = materialise(
        pieces.select("doc_id", "piece", "start", "length", "ids_crc32").withColumn(
            "shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)).cast("int")
        ),
        "pieces",
    )
    counted = materialise(
        stored.groupBy("length", "shard").agg(F.count(F.lit(1)).alias("rows")), "lengths"
    )
    lengths = {
        row["length"]: row["rows"]
        for row in counted.groupBy("length").agg(F.sum("rows").alias("rows")).collect()
    }
    if any(not 1 <= length <= capacity for length in lengths):
        raise ValueError(f"pieces must have 1 to {capacity} tokens")
    plan = spark.createDataFrame(plan_best_fit(lengths, capacity), PLAN)

    earlier = Window.partitionBy("length").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = counted.select(
        "length", "shard", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("length", "shard").orderBy(
        "doc_id", "piece", "start", "ids_crc32"
    )
    ranked = (
        stored.withColumn("nth", F.row_number().over(within))
        .join(starts, ["length", "shard"])
        .withColumn("rank", F.col("before") + F.col("nth") - 1)
        .drop("shard", "nth", "before")
    )
    place = F.col("rank") - F.col("first")
    # the plan is bounded by the capacity, see plan_best_fit
    return (
        ranked.join(
            F.broadcast(plan.withColumnRenamed("length", "of_length")),
            (F.col("length") == F.col("of_length"))
            & F.col("rank").between(F.col("first"), F.col("last")),
        )
        .select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("sequence") + F.floor(place / F.col("per_sequence"))).cast("long").alias(
                "sequence_id"
            ),
            (F.col("offset") + place % F.col("per_sequence") * F.col("length")).alias("offset"),
        )
    )
