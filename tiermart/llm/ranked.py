"""Ranked search: bundles of items pass through the owners of their terms and gather document scores."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiermart.llm.common import column, map_batches, ship_package, texts_of
from tiermart.session import materialise, scratch_path

SHARD = 16_384  # documents whose scores one bundle may carry
POSTINGS = 2_000_000  # postings after which a shard is closed early
BLOCK = 256  # items that are scored together in one group, about
SLOTS = 1 << 23  # bits of the filter of item terms, 1 MB
# Terms belong to owners by the share of documents that hold them; bundles visit the owners
# of rare and heavy terms first, so that few documents are left when the common terms come.
OWNERS = [1 / 256, 1 / 32, 1 / 8]

# what is not a term: ASCII but for digits and letters; only A-Z are lower-cased
_TERMS = bytes(
    b if chr(b).isalnum() or b >= 128 else 32 for b in range(128)
).lower() + bytes(range(128, 256))

INDEX = (
    "shard long, term binary, places binary, counts binary, peaks binary, "
    "ids array<long>, lengths binary, total long"
)
TERM = "struct<term:binary,weight:long,owner:int>"
BUNDLE = (
    f"shard long, block int, item_id long, terms array<{TERM}>, "
    "rest array<long>, places binary, scores binary"
)
FOUND = "item_id long, doc_id long, score long, shard long, place int"


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_TERMS).split()


def _peaks(counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The (count, length) pairs of which no other has more counts at no more length.

    The largest impact of a term is that of one of them, whatever the mean length is.
    """
    order = np.lexsort((lengths, -counts))
    counts, lengths = counts[order], lengths[order]
    shortest = np.minimum.accumulate(lengths)
    first = np.append(True, shortest[1:] < shortest[:-1])
    return np.stack([counts[first], lengths[first]]).astype(np.int64)


class _Shard:
    """Postings of some documents that follow each other in one input partition."""

    def __init__(self, number: int) -> None:
        self.number = number
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.postings: dict[bytes, tuple[list[int], list[int]]] = defaultdict(lambda: ([], []))
        self.size = 0

    def add(self, doc_id: int | None, counts: Counter, wanted: bytes) -> None:
        place = len(self.ids)
        self.ids.append(doc_id)
        self.lengths.append(counts.total())
        for term, count in counts.items():
            if wanted[zlib.crc32(term) & (SLOTS - 1)]:
                places, found = self.postings[term]
                places.append(place)
                found.append(count)
                self.size += 1

    def full(self) -> bool:
        return len(self.ids) >= SHARD or self.size >= POSTINGS

    def rows(self) -> Iterator[dict]:
        lengths = np.array(self.lengths, dtype=np.int64)
        yield {
            "shard": self.number, "ids": self.ids, "lengths": lengths.tobytes(), "total": int(lengths.sum())
        }
        for term, (places, counts) in self.postings.items():
            at, found = np.array(places, dtype=np.uint16), np.array(counts, dtype=np.int64)
            yield {
                "shard": self.number,
                "term": term,
                "places": at.tobytes(),
                "counts": found.astype(np.uint32).tobytes(),
                "peaks": _peaks(found, lengths[at]).tobytes(),
            }


_INDEX = pa.schema(
    {
        "shard": pa.int64(),
        "term": pa.binary(),
        "places": pa.binary(),
        "counts": pa.binary(),
        "peaks": pa.binary(),
        "ids": pa.list_(pa.int64()),
        "lengths": pa.binary(),
        "total": pa.int64(),
    }
)


def _indexed(docs: DataFrame, wanted: bytes) -> DataFrame:
    """Per shard a head (ids, lengths) and postings of every term that the filter lets pass.

    A filter of fixed size lets some other terms pass; they meet no item later.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        slots = np.unpackbits(np.frombuffer(wanted, np.uint8), bitorder="little").tobytes()
        shard = _Shard(first)
        for batch in batches:
            for doc_id, text in zip(column(batch, "doc_id"), texts_of(batch)):
                counts = Counter(terms_of(text))
                if not counts:
                    continue
                shard.add(doc_id, counts, slots)
                if shard.full():
                    yield pa.RecordBatch.from_pylist(list(shard.rows()), schema=_INDEX)
                    shard = _Shard(shard.number + 1)
        if shard.ids:
            yield pa.RecordBatch.from_pylist(list(shard.rows()), schema=_INDEX)

    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, INDEX)


def _item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), once each; rows of one item_id are one item."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        terms = [list(dict.fromkeys(terms_of(text))) for text in texts_of(batch)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(terms, type=pa.list_(pa.binary()))], names=["item_id", "terms"]
        )

    found = map_batches(
        items.select(F.col("item_id").cast("long"), "text"), run, "item_id long, terms array<binary>"
    )
    return found.select("item_id", F.explode("terms").alias("term")).distinct()


def _filter(terms: DataFrame) -> bytes:
    """A bit for the checksum of every term, in `SLOTS` bits however many terms there are."""
    slot = F.pmod(F.crc32("term"), F.lit(SLOTS)) + 1
    parts = (
        terms.select(slot.alias("slot"))
        .groupBy(F.bitmap_bucket_number("slot").alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    )
    bits = bytearray(SLOTS // 8)
    for row in parts.collect():  # at most 256 rows of 4 kB
        bits[(row.part - 1) * 4096 : row.part * 4096] = row.bits
    return bytes(bits)


def _impacts(counts: np.ndarray, lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What one unit of a term's weight adds to documents with these counts and lengths."""
    norm = 50 + (50 * lengths * documents) // total
    return (1_000_000_000 * counts) // (1000 * counts + 20 * norm)


def _visitor(owner: int, documents: int, total: int, best: int):
    """The work of one owner on the bundles of a shard and a block of items.

    A bundle carries the documents of its shard that may still be among the `best`: those whose score and
    everything that later owners can add, by the largest impact of each term in the
    shard, reach the present score of the last of the best. Leaving out the others changes no result: as many
    documents as are asked for end above them, also if they are met again.
    """
    last = owner == len(OWNERS)

    def visit(bundles: pa.Table, postings: pa.Table) -> Iterator[tuple]:
        heads = [row for row in postings.to_pylist() if row["term"] is None]
        if not heads or not bundles.num_rows:
            return
        lengths = np.frombuffer(heads[0]["lengths"], np.int64)
        impacts: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        peaks: dict[bytes, int] = {}
        for row in postings.to_pylist():
            if row["term"] is None:
                continue
            if row["peaks"] is not None:
                top = np.frombuffer(row["peaks"], np.int64).reshape(2, -1)
                peaks[row["term"]] = int(_impacts(top[0], top[1], documents, total).max())
            if row["places"] is not None:
                at = np.frombuffer(row["places"], np.uint16)
                counts = np.frombuffer(row["counts"], np.uint32).astype(np.int64)
                impacts[row["term"]] = at, _impacts(counts, lengths[at], documents, total)
        for bundle in bundles.to_pylist():
            rest = bundle["rest"]
            if rest is None:  # the first owner notes what each owner can add at most
                rest = [0] * (len(OWNERS) + 1)
                for term in bundle["terms"]:
                    rest[term["owner"]] += term["weight"] * peaks.get(term["term"], 0)
            scores = np.zeros(len(lengths), dtype=np.int64)
            if bundle["places"] is not None:
                at = np.frombuffer(bundle["places"], np.uint16)
                scores[at] = np.frombuffer(bundle["scores"], np.int64)
            for term in bundle["terms"]:
                if term["owner"] == owner and term["term"] in impacts:
                    at, added = impacts[term["term"]]
                    scores[at] += term["weight"] * added
            live = np.flatnonzero(scores)
            if len(live) > best:
                least = np.partition(scores[live], len(live) - best)[len(live) - best]
                live = live[scores[live] + sum(rest[owner + 1 :]) >= least]
            if last:
                ids = heads[0]["ids"]
                order = sorted(
                    live.tolist(), key=lambda i: (-scores[i], ids[i] is None, ids[i] or 0, i)
                )
                for i in order[:best]:
                    yield bundle["item_id"], ids[i], int(scores[i]), bundle["shard"], i
            else:
                yield (
                    *(bundle[name] for name in ("shard", "block", "item_id", "terms")),
                    rest,
                    live.astype(np.uint16).tobytes(),
                    scores[live].tobytes(),
                )

    kind = _FOUND if last else _BUNDLE

    def run(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        rows = list(visit(bundles, postings))
        columns = zip(*rows) if rows else [[]] * len(kind)
        return pa.table([pa.array(c, type=f.type) for c, f in zip(columns, kind)], schema=kind)

    return run


_TERM = pa.struct({"term": pa.binary(), "weight": pa.int64(), "owner": pa.int32()})
_BUNDLE = pa.schema(
    {
        "shard": pa.int64(),
        "block": pa.int32(),
        "item_id": pa.int64(),
        "terms": pa.list_(_TERM),
        "rest": pa.list_(pa.int64()),
        "places": pa.binary(),
        "scores": pa.binary(),
    }
)
_FOUND = pa.schema(
    {
        "item_id": pa.int64(),
        "doc_id": pa.int64(),
        "score": pa.int64(),
        "shard": pa.int64(),
        "place": pa.int32(),
    }
)


def ranked_search(docs: DataFrame, items: DataFrame, best: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the `best` documents of docs(doc_id, text) per item of items(item_id, text).

    Terms are runs of ASCII letters and digits and of any characters beyond ASCII, only A-Z
    lower-cased. Documents without terms, null and empty texts included, take no part; items without
    terms have no rows. Rows that repeat a doc_id are documents of their own, rows
    that repeat an item_id form one item. A null id is an id like others and comes last among
    equal scores. Other columns are ignored, empty tables give no rows.

    Documents are indexed once, in shards of bounded size, for the terms that a filter of fixed size
    lets pass. Terms then belong to owners by how many documents hold them. For every shard and block of
    items, a bundle per item goes from owner to owner; each adds the integer contributions of its terms to the
    bundle's sparse scores. Every term of every document counts; what bundles leave
    behind cannot be among the best of its shard.
    """
    spark = docs.sparkSession
    terms = materialise(_item_terms(items), "item-terms")
    index = materialise(_indexed(docs, _filter(terms)), "index")
    heads = index.where(F.col("term").isNull())
    sums = heads.agg(F.sum(F.size("ids")).alias("documents"), F.sum("total").alias("total")).first()
    documents, total = sums.documents or 0, sums.total or 1

    held = (
        index.where(F.col("term").isNotNull())
        .groupBy("term")
        .agg(F.sum(F.length("places") / 2).cast("long").alias("df"))
    )
    blocks = -(-max(terms.select("item_id").distinct().count(), 1) // BLOCK)
    owner = sum(
        (F.col("df") > share * documents).cast("int") for share in OWNERS
    )
    weight = F.floor(1000 * F.ln(F.lit(2 * documents + 2).cast("double") / (2 * F.col("df") + 1)))
    known = materialise(
        terms.join(held, "term").select(
            "item_id",
            F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int").alias("block"),
            "term",
            weight.cast("long").alias("weight"),
            owner.alias("owner"),
        ),
        "known-terms",
    )
    routes = materialise(known.select("term", "block", "owner").distinct(), "routes")
    path = scratch_path(spark, "postings")
    (
        index.join(routes, "term")
        .select("shard", "block", "owner", "term", "places", "counts", "peaks")
        .write.partitionBy("owner")
        .parquet(path)
    )
    postings = spark.read.schema(
        "shard long, block int, term binary, places binary, counts binary, peaks binary, owner int"
    ).parquet(path)
    met = materialise(postings.select("shard", "block").distinct(), "met")
    grouped = materialise(
        known.groupBy("block", "item_id").agg(
            F.collect_list(F.struct("term", "weight", "owner")).alias("terms")
        ),
        "items",
    )
    empty = [F.lit(None).cast(kind) for kind in ("array<long>", "binary", "binary")]
    bundles = met.join(grouped, "block").select(
        "shard", "block", "item_id", "terms", *[e.alias(n) for e, n in zip(empty, ("rest", "places", "scores"))]
    )
    for number in range(len(OWNERS) + 1):
        first, last = number == 0, number == len(OWNERS)
        none = F.lit(None).cast("binary")
        mine = F.col("owner") == number
        right = postings if first else postings.where(mine)
        right = right.select(
            "shard",
            "block",
            "term",
            *[F.when(mine, F.col(c)).alias(c) for c in ("places", "counts")],
            F.col("peaks") if first else none.alias("peaks"),
            F.lit(None).cast("array<long>").alias("ids"),
            none.alias("lengths"),
        ).union(
            met.join(heads, "shard").select(
                "shard",
                "block",
                *[none.alias(c) for c in ("term", "places", "counts", "peaks")],
                F.col("ids") if last else F.lit(None).cast("array<long>").alias("ids"),
                "lengths",
            )
        )
        bundles = (
            bundles.groupBy("shard", "block")
            .cogroup(right.groupBy("shard", "block"))
            .applyInArrow(
                _visitor(number, documents, total, best), FOUND if last else BUNDLE
            )
        )
    window = Window.partitionBy("item_id").orderBy(
        F.desc("score"), F.asc_nulls_last("doc_id"), "shard", "place"
    )
    return (
        bundles.withColumn("rank", F.row_number().over(window))
        .where(F.col("rank") <= best)
        .select("item_id", "rank", "doc_id", "score")
    )
