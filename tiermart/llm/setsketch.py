"""Near-duplicate documents by SetSketch registers of their word shingles."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiermart.llm.common import column, map_batches, small_batches, texts_of
from tiermart.llm.components import connected_components
from tiermart.session import materialise

REGISTERS = 126
MOST_ROWS = 6  # registers of a band, at most
MISSED = 1e-4  # chance that a pair at the threshold shares no band, at most
BASE = 1.001  # registers are logarithms to this base
RATE = 20.0
LIMIT = 65_534  # largest register, below it is 0
SALTS = 16  # parts of a component when its classes learn its smallest id
BLOCK = 256  # documents of one side when a bucket is compared in blocks

_MULTIPLIERS, _SHIFTS = (
    np.random.default_rng(20_211).integers(0, 2**64, (2, REGISTERS), dtype=np.uint64)
)
_MULTIPLIERS = _MULTIPLIERS | np.uint64(1)


class _Hashes(dict):
    """word -> 64-bit hash, computed once per word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _Hashes()


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text.

    Words are divided by ASCII white space, A-Z lower-cased. Fewer words than `size` make one
    shingle of all of them, no words none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    total = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        total = (total ^ hashes[i : i + len(total)]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    total = total * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(total ^ (total >> np.uint64(32)))


def minima(values: np.ndarray) -> np.ndarray:
    """The smallest of each of the hash functions over a set; minima of a union are minima of minima."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(values), 512):
        part = values[start : start + 512, None] * _MULTIPLIERS + _SHIFTS
        part ^= part >> np.uint64(31)
        np.minimum(least, part.min(axis=0), out=least)
    return least


def registers(least: np.ndarray) -> np.ndarray:
    """Exponentially spaced, truncated: 1 - log(-ln(1 - u) / rate), rounded down, from 0 to LIMIT."""
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    waiting = -np.log1p(-np.minimum(uniform, 1 - 1e-16))
    places = np.floor(1 - np.log(waiting / RATE) / math.log(BASE))
    return np.clip(places, 0, LIMIT).astype("<u2")


def likely(
    least: float, higher: np.ndarray, lower: np.ndarray, n_left: np.ndarray, n_right: np.ndarray
) -> np.ndarray:
    """Whether the maximum-likelihood similarity of pairs of sets of known sizes is `least` or more.

    `higher` and `lower` count the registers in which the left sketch is above and below the right
    one. The likelihood of a similarity is concave, so its maximum lies at `least` or above
    if its slope there is not negative.
    """
    u = n_left / (n_left + n_right)
    v = 1 - u
    possible = np.minimum(u, v) >= least * np.maximum(u, v)
    spacing, scale = (BASE - 1) / BASE, math.log(BASE)
    a, b = np.maximum(u - v * least, 1e-12), np.maximum(v - u * least, 1e-12)
    # chance of a register above and below, and its change with the similarity
    above, below = -np.log1p(-a * spacing) / scale, -np.log1p(-b * spacing) / scale
    d_above = -v * spacing / (1 - a * spacing) / scale
    d_below = -u * spacing / (1 - b * spacing) / scale
    equal = REGISTERS - higher - lower
    slope = (
        higher * d_above / above
        + lower * d_below / below
        - equal * (d_above + d_below) / (1 - above - below)
    )
    return possible & (slope >= 0)


@dataclass(frozen=True)
class NearDuplicates:
    """Settings: documents link if 100 * intersection >= percent * union of their shingles."""

    percent: int = 80
    size: int = 5

    def missed(self, rows: int) -> float:
        """The chance that a pair at the threshold shares no band of so many registers."""
        return (1 - (self.percent / 100) ** rows) ** (REGISTERS // rows)

    @property
    def rows(self) -> int:
        """Registers of a band: as many as miss few enough pairs."""
        return next((n for n in range(MOST_ROWS, 1, -1) if self.missed(n) < MISSED), 1)

    @property
    def bands(self) -> int:
        return REGISTERS // self.rows

    @property
    def least_estimate(self) -> float:
        """Four standard deviations of the estimate below the threshold."""
        t = self.percent / 100
        return t - 4 * math.sqrt(t * (1 - t) / REGISTERS)


    def links(self, one: np.ndarray, other: np.ndarray) -> bool:
        shared = len(np.intersect1d(one, other, assume_unique=True))
        return 100 * shared >= self.percent * (len(one) + len(other) - shared)


SKETCH = "row_id long, n_shingles long, class string, sketch binary"


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """(row_id, n_shingles, class, sketch) of docs(doc_id, text); `class` names the shingle set."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc_id, text in zip(column(batch, "doc_id"), texts_of(batch)):
            values = shingles(text, size)
            if len(values):
                name = xxhash.xxh3_128_hexdigest(values.tobytes())
                rows.append((doc_id, len(values), name, registers(minima(values)).tobytes()))
            else:
                rows.append((doc_id, 0, None, None))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(v, type=k) for v, k in zip(zip(*rows), kinds)],
            names=["row_id", "n_shingles", "class", "sketch"],
        )

    return map_batches(
        docs.select(F.col("doc_id").cast("long"), "text"),
        lambda batch: run(batch) if batch.num_rows else None,
        SKETCH,
    )


def _buckets(firsts: DataFrame, rule: NearDuplicates) -> DataFrame:
    """(bucket, band, node): one row per band of each sketch."""
    size = 2 * rule.rows  # bytes
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(rule.bands - 1)),
        lambda i: F.struct(
            F.xxhash64(i, F.substring("sketch", i * size + 1, F.lit(size))).alias("bucket"),
            i.alias("band"),
        ),
    )
    return firsts.select(F.explode(bands).alias("key"), "node").select("key.*", "node")


def _crowded(buckets: DataFrame) -> DataFrame:
    """The buckets that hold several documents; of buckets with the same documents that of the
    first band."""
    found = (
        buckets.groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.min("band").alias("band"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("one"),
            F.bit_xor(F.xxhash64("node", F.lit(2))).alias("two"),
        )
        .where(F.col("size") > 1)
    )
    return (
        found.groupBy("size", "one", "two")
        .agg(F.min(F.struct("band", "bucket")).alias("first"))
        .select("first.bucket")
    )


def _placed(members: DataFrame, grouped: DataFrame | None) -> DataFrame:
    """members(bucket, band, node) with their present component, at first themselves."""
    if grouped is None:
        return members.withColumn("component", F.col("node"))
    known = grouped.select("node", F.col("component").alias("found"))
    return members.join(known, "node", "left").select(
        "bucket", "band", "node", F.coalesce("found", "node").alias("component")
    )


def _cores(placed: DataFrame, turn: int) -> DataFrame:
    """(bucket, size, core) of buckets with several components: `core` (n, component, pivot) is
    the one with most members, and the pivot a member that a hash of the turn chooses."""
    groups = placed.groupBy("bucket", "component").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("node", F.xxhash64("node", F.lit(turn))).alias("pivot")
    )
    return (
        groups.groupBy("bucket")
        .agg(
            F.sum("n").alias("size"),
            F.max(F.struct("n", "component", "pivot")).alias("core"),
            F.count(F.lit(1)).alias("components"),
        )
        .where(F.col("components") > 1)
        .drop("components")
    )


def _proposals(placed: DataFrame, turn: int) -> DataFrame:
    """(left, right): one pair for each document outside a core of its buckets, with the pivot of
    the largest one."""
    return (
        placed.join(materialise(_cores(placed, turn), "cores"), "bucket")
        .where(F.col("component") != F.col("core.component"))
        .groupBy("node")
        .agg(F.max(F.struct("core.n", "core.pivot")).alias("best"))
        .select(F.col("best.pivot").alias("left"), F.col("node").alias("right"))
    )


def _verified(pairs: DataFrame, texts: DataFrame, rule: NearDuplicates) -> DataFrame:
    """The (left, right) pairs whose full shingle sets are similar enough."""
    left = texts.select(F.col("node").alias("left"), F.col("text").alias("left_text"))
    right = texts.select(F.col("node").alias("right"), F.col("text").alias("right_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}

        def of(node: int, text: str) -> np.ndarray:
            if node not in known:
                if len(known) > 200:
                    known.clear()
                known[node] = shingles(text, rule.size)
            return known[node]

        for batch in batches:
            kept = []
            for a, b, one, other in zip(
                *(column(batch, n) for n in ("left", "right", "left_text", "right_text"))
            ):
                if rule.links(of(a, one), of(b, other)):
                    kept.append((a, b))
            if kept:
                columns = [pa.array(v, type=pa.int64()) for v in zip(*kept)]
                yield pa.RecordBatch.from_arrays(columns, names=["left", "right"])

    joined = pairs.join(left, "left").join(right, "right")
    return joined.select("left", "right", "left_text", "right_text").mapInArrow(
        run, "left long, right long"
    )


def _estimated(pairs: DataFrame, firsts: DataFrame, rule: NearDuplicates) -> DataFrame:
    """The (left, right) pairs whose likeliest similarity is near the threshold or above."""
    sketch = firsts.select("node", "sketch", "n_shingles")
    sides = pairs
    for side in ("left", "right"):
        sides = sides.join(
            sketch.select(
                F.col("node").alias(side),
                F.col("sketch").alias(f"{side}_sketch"),
                F.col("n_shingles").alias(f"{side}_n"),
            ),
            side,
        )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = (_sketch_matrix(column(batch, f"{s}_sketch")) for s in ("left", "right"))
        n, m = (np.array(column(batch, f"{s}_n"), dtype=float) for s in ("left", "right"))
        good = likely(rule.least_estimate, (a > b).sum(axis=1), (a < b).sum(axis=1), n, m)
        return batch.select(["left", "right"]).filter(pa.array(good))

    return map_batches(
        sides, lambda b: run(b) if b.num_rows else None, "left long, right long"
    )


def _sketch_matrix(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype="<u2").reshape(-1, REGISTERS)


def _sides(placed: DataFrame) -> DataFrame:
    """The members of buckets with several components, with (mine, others): their block, and how many
    blocks from 0 on it meets.

    The rest of a bucket has the blocks with the smallest numbers, its core the others. Blocks of the
    core meet those of the rest only, so a large group that is united costs one
    comparison per member and block of others.
    """
    core = F.col("core.n")
    mixed = materialise(
        _cores(placed, 0).select(
            "bucket",
            F.col("core.component").alias("core"),
            F.ceil((F.col("size") - core) / BLOCK).cast("int").alias("rest"),
            F.ceil(core / BLOCK).cast("int").alias("cores"),
        ),
        "mixed",
    )
    hashed = F.xxhash64("node", F.lit(3))
    in_core = F.col("component") == F.col("core")
    return placed.join(mixed, "bucket").select(
        "bucket",
        "band",
        "node",
        "component",
        F.when(in_core, F.col("rest") + F.pmod(hashed, F.col("cores")))
        .otherwise(F.pmod(hashed, F.col("rest")))
        .cast("int")
        .alias("mine"),
        F.when(in_core, F.col("rest")).otherwise(F.col("rest") + F.col("cores")).alias("others"),
    )


def _block_links(
    placed: DataFrame, firsts: DataFrame, texts: DataFrame, rule: NearDuplicates
) -> DataFrame:
    """(left, right): links that unite the components which meet in a bucket.

    In each pair of blocks the pairs of different components that are likely are verified by their full
    sets, the likeliest first, unless earlier ones have united them. A pair is
    compared in the first band that both share. Sketches meet first; a text is sent only to the pairs of blocks where
    its document is in a likely pair.
    """
    dealt = (
        _sides(placed)
        .join(firsts.select("node", "sketch", "n_shingles"), "node")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
        .withColumn("low", F.least("mine", "other"))
        .withColumn("high", F.greatest("mine", "other"))
        .drop("other", "others")
    )

    names = dealt.columns

    def likely_pairs(key, table) -> list[tuple[int, int, int]]:
        """(unequal registers, i, j) of the pairs of rows to verify."""
        low, high = key[1].as_py(), key[2].as_py()
        groups = np.array(table.column("component").to_pylist(), dtype=np.int64)
        mine = np.array(table.column("mine").to_pylist())
        sizes = np.array(table.column("n_shingles").to_pylist(), dtype=float)
        sketch = _sketch_matrix(table.column("sketch").to_pylist())
        earlier = rule.rows * table.column("band")[0].as_py()
        pairs = []
        for i in range(len(groups) - 1):
            others = groups[i + 1 :] != groups[i]
            if low != high:
                others &= mine[i + 1 :] != mine[i]
            js = i + 1 + np.flatnonzero(others)
            if not len(js):
                continue
            higher = (sketch[i] > sketch[js]).sum(axis=1)
            lower = (sketch[i] < sketch[js]).sum(axis=1)
            good = likely(rule.least_estimate, higher, lower, np.full(len(js), sizes[i]), sizes[js])
            js, unequal = js[good], (higher + lower)[good]
            if earlier and len(js):
                same = (sketch[i, :earlier] == sketch[js, :earlier]).reshape(len(js), -1, rule.rows)
                new = ~same.all(axis=2).any(axis=1)
                js, unequal = js[new], unequal[new]
            pairs += [(int(d), i, int(j)) for d, j in zip(unequal, js)]
        return pairs

    def candidates(key, table):
        found = {i for _, *pair in likely_pairs(key, table) for i in pair}
        low, high = (pa.array([k.as_py()] * len(found), type=pa.int32()) for k in key[1:])
        some = table.take(pa.array(sorted(found), type=pa.int64())).drop_columns(["low", "high"])
        return some.append_column("low", low).append_column("high", high).select(names)

    def compare(key, table):
        nodes = table.column("node").to_pylist()
        groups = table.column("component").to_pylist()
        pairs = likely_pairs(key, table)
        whole = table.column("text")
        sets: dict[int, np.ndarray] = {}

        def of(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingles(whole[i].as_py(), rule.size)
            return sets[i]

        root: dict[int, int] = {}

        def find(g: int) -> int:
            while root.get(g, g) != g:
                g = root[g]
            return g

        links = []
        for _, i, j in sorted(pairs):
            a, b = find(groups[i]), find(groups[j])
            if a != b and rule.links(of(i), of(j)):
                root[max(a, b)] = min(a, b)
                links.append((nodes[i], nodes[j]))
        left, right = zip(*links) if links else ([], [])
        return pa.table(
            {"left": pa.array(left, type=pa.int64()), "right": pa.array(right, type=pa.int64())}
        )

    blocks = ["bucket", "low", "high"]
    likeliest = materialise(dealt.groupBy(*blocks).applyInArrow(candidates, dealt.schema), "candidates")
    return likeliest.join(texts, "node").groupBy(*blocks).applyInArrow(compare, "left long, right long")


def near_duplicates(docs: DataFrame, rule: NearDuplicates = NearDuplicates()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of docs(doc_id, text).

    Documents link if their sets of word shingles are similar enough; a document without words links with
    nothing. `component_id` is the smallest doc_id that links reach. One row per input
    row. Rows that repeat an id are one document, whose links are those of all of them. A
    row without id is a component of its own, null, and kept. Other
    columns are ignored.

    1. Equal sets are one class. 2. Classes whose registers agree in a band share a bucket. 3. Each
    class is compared with the smallest one that it shares a bucket with: first by joint estimate, then by
    the full sets. 4. Buckets that still hold several components are compared in blocks: each document
    proposes its likeliest partners of other components, ever more of them, until
    every candidate above the estimate's margin is verified or united. Bands follow from the threshold:
    a pair at it shares no bucket with a probability of 5 in 100,000 at 85 percent (21 bands of 6
    registers) and at 80 percent (25 bands of 5), and below 1 in 10,000 at all from 10 percent on.
    """
    with small_batches(docs.sparkSession):
        return _near_duplicates(docs, rule)


def _near_duplicates(docs: DataFrame, rule: NearDuplicates) -> DataFrame:
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    every = materialise(sketches(named, rule.size), "sketches")
    usable = every.where(F.col("row_id").isNotNull() & F.col("class").isNotNull())
    firsts = materialise(
        usable.groupBy("class")
        .agg(
            F.min("row_id").alias("rep"),
            F.count(F.lit(1)).alias("rows"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("sketch").alias("sketch"),
        )
        # one id may have several sets, so classes have numbers of their own
        .withColumn("node", F.xxhash64("class")),
        "classes",
    )
    buckets = _buckets(firsts, rule)
    crowded = materialise(_crowded(buckets), "crowded")
    members = materialise(buckets.join(crowded, "bucket"), "members")

    near = materialise(members.select("node").distinct(), "near")
    texts = materialise(_texts(named, firsts.join(near, "node"), rule), "texts")
    links = grouped = None
    turn, asked, united = 0, 1, 1
    while asked and 4 * united >= asked:
        pairs = materialise(_proposals(_placed(members, grouped), turn), "pairs")
        # stored, so that a task runs one Python worker at a time
        likeliest = materialise(_estimated(pairs, firsts, rule), "likely")
        found = materialise(_verified(likeliest, texts, rule), "found")
        links = found if links is None else links.union(found)
        grouped = materialise(connected_components(links, "left", "right"), "components")
        turn, asked, united = turn + 1, pairs.count(), found.count()
    placed = materialise(_placed(members, grouped), "placed")
    links = materialise(links.union(_block_links(placed, firsts, texts, rule)), "links")
    grouped = materialise(connected_components(links, "left", "right"), "components")

    known = materialise(_known(firsts, usable, grouped), "known")
    linked = every.join(known, F.col("row_id") == F.col("doc_id"), "left")
    return linked.select(
        F.col("row_id").alias("doc_id"),
        "n_shingles",
        F.coalesce("component_id", "row_id").alias("component_id"),
        (F.coalesce("component_id", "row_id") == F.col("row_id")).alias("kept"),
    ).withColumn("kept", F.coalesce("kept", F.lit(True)))


def _texts(named: DataFrame, firsts: DataFrame, rule: NearDuplicates) -> DataFrame:
    """(node, text) of classes, one text each; documents move once, by id."""
    wanted = firsts.select(F.col("rep").alias("doc_id"), "node", "class")

    def same(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = [
            xxhash.xxh3_128_hexdigest(shingles(text, rule.size).tobytes())
            for text in texts_of(batch)
        ]
        right = pa.array([a == b for a, b in zip(names, column(batch, "class"))], type=pa.bool_())
        return batch.select(["node", "text"]).filter(right)

    # an id may stand for several texts; the class tells which is meant
    return map_batches(
        named.join(wanted, "doc_id").select("node", "class", "text"),
        same,
        "node long, text string",
    ).dropDuplicates(["node"])


def _known(firsts: DataFrame, usable: DataFrame, grouped: DataFrame) -> DataFrame:
    """(doc_id, component_id) of the documents that link with another row.

    The classes of a component are divided into SALTS parts, each of which meets a copy of the one row of the
    component, so a very large one is no hot key.
    """
    part = F.pmod(F.xxhash64("node", F.lit(5)), F.lit(SALTS)).cast("int")
    classes = (
        firsts.select("class", "node", "rep", "rows")
        .join(grouped, "node", "left")
        .select("class", "rep", "rows", F.coalesce("component", "node").alias("whole"), part.alias("part"))
    )
    smallest = (
        classes.groupBy("whole")
        .agg(F.min("rep").alias("component_id"), F.sum("rows").alias("whole_rows"))
        .where(F.col("whole_rows") > 1)
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    united = materialise(
        classes.join(smallest, ["whole", "part"]).select("class", "component_id"), "united"
    )
    pairs = usable.select(F.col("row_id").alias("doc_id"), "class").join(united, "class")
    # an id with several sets joins their components
    ids = materialise(pairs.select("doc_id", "component_id").distinct(), "ids")
    repeated = ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    if repeated.isEmpty():
        return ids
    whole = connected_components(ids, "doc_id", "component_id")
    return whole.select(F.col("node").alias("doc_id"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, rule: NearDuplicates = NearDuplicates()) -> DataFrame:
    """The rows of docs(doc_id, text, ...) that are kept, one per group and id.

    Of rows that repeat an id, the one with the smallest text stays; rows without id all stay. All
    columns are kept as they are.
    """
    found = near_duplicates(docs, rule)
    kept = found.where(F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    named = docs.where(F.col("doc_id").isNotNull()).join(kept, "doc_id", "left_semi")
    number = Window.partitionBy("doc_id").orderBy("text", *[c for c in docs.columns if c not in ("doc_id", "text")])
    nth = "nth row of the id"
    while nth in docs.columns:
        nth += "_"
    once = named.withColumn(nth, F.row_number().over(number)).where(F.col(nth) == 1).drop(nth)
    return once.union(docs.where(F.col("doc_id").isNull()).select(once.columns)).select(docs.columns)
