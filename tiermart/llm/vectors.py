"""Near-duplicate vectors by a forest of random-projection trees."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermart.llm.common import column, map_batches
from tiermart.llm.components import connected_components
from tiermart.session import materialise

TREES = 6  # at least
MISS = 0.02  # chance that no tree brings a pair at the threshold together, at most
LEAF = 2048  # vectors that are compared with each other
CELL = 8192  # vectors of a cell, whose trees are grown in one task
BLOCK = 256  # vectors of one side when links are counted
SAMPLE = 4096  # vectors of a larger cell that its trees are fitted on, about
SHARE = 65_536  # vectors of a larger cell that one task leads down its trees, about
# Half the width of the strip on both sides of a split whose vectors go to both sides. The
# projections of two unit vectors of cosine 0.98 on a random direction of unit
# variance differ by 0.2 in standard deviation.
SPILL = 0.1
GROWTH = 1.2  # rows on both sides of a split against the rows before, at most


def _random(*key: int) -> np.random.Generator:
    return np.random.default_rng(np.array(key, dtype=np.uint64))


def _split(vectors: np.ndarray, key: tuple[int, ...], spill: float = SPILL):
    """A random direction, the point that halves the vectors on it, and the strip.

    The strip is narrowed where more than a fifth of the vectors would be on both sides; more trees then
    make up for it, see `_grow`. None if so many vectors have the same place that one side
    would keep nearly all.
    """
    direction = _random(*key).standard_normal(vectors.shape[1])
    places = vectors @ direction
    middle = float(np.median(places))
    while True:
        low, high = (side.mean() for side in _sides(places, middle, spill))
        if low + high <= GROWTH and max(low, high) <= 0.875:
            return direction, middle, spill
        if not spill:
            return None
        spill = spill / 2 if spill > 1e-9 else 0.0


def _sides(places: np.ndarray, middle: float, spill: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows below and above the split; those in the strip around it are in both."""
    return places < middle + spill, places >= middle - spill


def _missed(places: np.ndarray, middle: float, strip: float, chord: float) -> float:
    """The chance that a split divides two vectors `chord` apart and neither lies in the strip.

    Their places differ by a normal variable of deviation `chord`. They are divided where the
    difference crosses the whole strip, which happens as often as the part of it beyond the strip is long, times
    the density of places at the split. Where vectors lie so close that most pairs are links, pairs
    are united by others; the density counts as if they were just too far apart for that.
    """
    width = 0.5 * float(places.std())
    density = float((np.abs(places - middle) <= width).mean()) / (2 * width) if width else math.inf
    density = min(density, math.sqrt(2) / (chord * math.sqrt(2 * math.pi)))
    z = 2 * strip / chord
    beyond = math.exp(-z * z / 2) / math.sqrt(2 * math.pi) - z * math.erfc(z / math.sqrt(2)) / 2
    return min(2 * chord * beyond * density, 1.0)


def leaves(vectors: np.ndarray, tree: int, leaf: int = LEAF) -> Iterator[np.ndarray]:
    """Row numbers of each leaf of one random tree; a node with more than `leaf` rows is split."""
    waiting = [(np.arange(len(vectors)), 1)]
    while waiting:
        rows, node = waiting.pop()
        found = _split(vectors[rows], (tree, node)) if len(rows) > leaf else None
        if found is None:
            yield rows
            continue
        direction, middle, strip = found
        low, high = _sides(vectors[rows] @ direction, middle, strip)
        waiting += [(rows[low], 2 * node), (rows[high], 2 * node + 1)]


def _group_links(ids: np.ndarray, vectors: np.ndarray, least: float, trees: range) -> np.ndarray:
    """The smallest id that links within leaves reach, for each row."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    root = np.arange(len(ids))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for tree in trees:
        for rows in leaves(vectors, tree):
            if len(rows) < 2:
                continue
            rows = np.sort(rows)
            near = vectors[rows] @ vectors[rows].T >= least
            np.fill_diagonal(near, True)
            linked = near.sum(axis=1) > 1
            if not linked.any():
                continue
            rows, near = rows[linked], near[np.ix_(linked, linked)]
            label = np.arange(len(rows))
            while True:
                smallest = np.where(near, label[None, :], len(rows)).min(axis=1)
                if (smallest == label).all():
                    break
                label = smallest
            for i, j in zip(rows.tolist(), rows[label].tolist()):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    found = np.empty(len(ids), dtype=np.int64)
    found[order] = ids[[find(i) for i in range(len(ids))]]
    return found


def _unit(vec_id: int | None, label: str | None, values: list | None) -> bytes | None:
    """The unit vector as doubles, or None for a row that links with nothing."""
    if vec_id is None or label is None or not values or any(v is None for v in values):
        return None
    vector = np.array(values, dtype=np.float64)
    largest = np.abs(vector).max()
    if not np.isfinite(vector).all() or not largest:
        return None
    vector = vector / largest
    return (vector / np.linalg.norm(vector) + 0.0).tobytes()


def _units(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = list(zip(*(column(batch, name) for name in ("vec_id", "label", "embedding"))))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([row[0] for row in rows], type=pa.int64()),
            pa.array([row[1] for row in rows], type=pa.string()),
            pa.array([_unit(*row) for row in rows], type=pa.binary()),
        ],
        names=["vec_id", "label", "unit"],
    )


def _matrix(units) -> np.ndarray:
    return np.stack([np.frombuffer(unit, dtype=np.float64) for unit in units])


POINTS = "array<struct<tree:int,node:long,middle:double,strip:double>>"
POINT = {"tree": pa.int32(), "node": pa.int64(), "middle": pa.float64(), "strip": pa.float64()}
GROWN = pa.schema(
    {"cell": pa.string(), "size": pa.int64(), "points": pa.list_(pa.struct(list(POINT.items())))}
)


def _key(cell: str, tree: int, node: int) -> tuple[int, ...]:
    """What a direction of the upper trees is drawn from: every cell has its own."""
    return 1000, zlib.crc32(cell.encode()), tree, node


def _tree(cell: str, vectors: np.ndarray, size: int, limit: int, tree: int, chord: float):
    """Split points of one tree, and the chance that it brings a pair `chord` apart together.

    A node is split until `limit` rows are left in it, or too few of the sample; levels that are left
    for later trees count as the levels above them do.
    """
    share = len(vectors) / size
    points, together = [], 0.0
    waiting = [(np.arange(len(vectors)), 1, 0.0, 0)]
    while waiting:
        rows, node, kept, depth = waiting.pop()
        small = len(rows) < 16 or (node > 1 and len(rows) / share <= limit)
        found = None if small else _split(vectors[rows], _key(cell, tree, node))
        if found is None:
            left = math.log(max(len(rows) / share / limit, 1)) / math.log(2 / GROWTH)
            together += len(rows) / len(vectors) * math.exp(kept * (1 + left / max(depth, 1)))
            continue
        direction, middle, strip = found
        points.append({"tree": tree, "node": node, "middle": middle, "strip": strip})
        places = vectors[rows] @ direction
        kept += math.log1p(-min(_missed(places, middle, strip, chord), 0.999))
        low, high = _sides(places, middle, 0.0)
        waiting += [(rows[low], 2 * node, kept, depth + 1), (rows[high], 2 * node + 1, kept, depth + 1)]
    return points, together


def _grow(
    cell: str, vectors: np.ndarray, size: int, limit: int, chord: float, forest: bool
) -> list[dict]:
    """Split points (tree, node, middle, strip) of a cell of `size` rows, from a sample of them.

    A forest has as many trees as leave a pair at the threshold apart with a chance of `MISS` at most, however
    deep and dense the cell is, and `TREES` at least. Empty for a cell that cannot be split.
    """
    points: list[dict] = []
    missed, tree = 1.0, 0
    while tree == 0 or (forest and (tree < TREES or missed > MISS)):
        found, together = _tree(cell, vectors, size, limit, tree, chord)
        if not found:
            break
        points += found
        missed *= 1 - together
        tree += 1
    return points


def _grown(rows: DataFrame, limit: int, level: int, chord: float) -> DataFrame:
    """(cell, size, points) of the cells of rows(cell, size, node, unit) that can be split.

    A hash of the row chooses a sample of about `SAMPLE` rows of every cell, or all if it has fewer.
    """

    def grow(key, table):
        cell, size = key[0].as_py(), key[1].as_py()
        sample = _matrix(sorted(table.column("unit").to_pylist()))
        points = _grow(cell, sample, size, limit, chord, level == 0)
        found = [{"cell": cell, "size": size, "points": points}] if points else []
        return pa.Table.from_pylist(found, schema=GROWN)

    part = F.pmod(F.xxhash64("node", F.lit(11 + level)), F.lit(1 << 40))
    chosen = part * F.col("size") < F.lit(SAMPLE).cast("double") * (1 << 40)
    return (
        rows.where(chosen)
        .groupBy("cell", "size")
        .applyInArrow(grow, f"cell string, size long, points {POINTS}")
    )


def _led(rows: DataFrame, grown: DataFrame) -> DataFrame:
    """(cell, node, unit): the cells that rows(cell, size, node, unit) reach down the trees of their cell.

    The rows of a cell are dealt to as many tasks as it has shares; the split points go
    to each of them and are sorted before the rows.
    """
    shares = F.ceil(F.col("size") / SHARE).cast("int")
    dealt = rows.select(
        "cell",
        F.pmod(F.xxhash64("node", F.lit(13)), shares).cast("int").alias("part"),
        F.lit(1).alias("kind"),
        "node",
        "unit",
        F.lit(None).cast(POINTS).alias("points"),
    )
    known = grown.select(
        "cell",
        F.explode(F.sequence(F.lit(0), shares - 1)).alias("part"),
        F.lit(0).alias("kind"),
        F.lit(None).cast("long").alias("node"),
        F.lit(None).cast("binary").alias("unit"),
        "points",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[int, dict[int, tuple[float, float]]] = {}
        directions: dict[tuple[int, int], np.ndarray] = {}  # of the present cell
        for batch in batches:
            out = []
            names = ("cell", "kind", "node", "unit", "points")
            events = zip(*(column(batch, name) for name in names))
            for (cell, kind), rows in groupby(events, key=lambda event: event[:2]):
                if kind == 0:
                    trees, directions = {}, {}
                    for point in list(rows)[-1][4]:
                        tree = trees.setdefault(point["tree"], {})
                        tree[point["node"]] = point["middle"], point["strip"]
                    continue
                _, _, nodes, units, _ = zip(*rows)
                for tree, node, found in _walk(cell, _matrix(units), trees, directions):
                    out += [(f"{cell}/{tree}.{node}", nodes[i], units[i]) for i in found]
            if out:
                kinds = (pa.string(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, type=k) for v, k in zip(zip(*out), kinds)],
                    names=["cell", "node", "unit"],
                )

    return (
        dealt.union(known)
        .repartition("cell", "part")
        .sortWithinPartitions("cell", "part", "kind")
        .mapInArrow(run, "cell string, node long, unit binary")
    )


def _walk(cell: str, vectors: np.ndarray, trees: dict, directions: dict):
    """(tree, leaf, row numbers) of the leaves that some of the vectors reach."""
    for tree, points in trees.items():
        waiting = [(np.arange(len(vectors)), 1)]
        while waiting:
            rows, node = waiting.pop()
            if not len(rows):
                continue
            if node not in points:
                yield tree, node, rows
                continue
            if (tree, node) not in directions:
                drawn = _random(*_key(cell, tree, node))
                directions[tree, node] = drawn.standard_normal(vectors.shape[1])
            low, high = _sides(vectors[rows] @ directions[tree, node], *points[node])
            waiting += [(rows[low], 2 * node), (rows[high], 2 * node + 1)]


def _cells(rows: DataFrame, limit: int, chord: float = 0.2) -> DataFrame:
    """(cell, node, unit): groups of rows small enough for one task.

    A group is a label and a number of dimensions. One that has more than `limit` rows is
    divided by a forest, and cells that are still too large by one further tree of
    their own, until none is. Trees are grown in tasks, each on a bounded sample of its
    cell; every row is led down them, and down both sides of a split that is near. Rows
    so alike that no direction divides them are dealt by hashes, once per tree.
    """
    active = rows.select(
        F.concat_ws("/", F.length("label"), "label", F.length("unit")).alias("cell"), "node", "unit"
    )
    done: list[DataFrame] = []
    level = 0
    while True:
        crowded = materialise(
            active.groupBy("cell")
            .agg(F.count(F.lit(1)).alias("size"))
            .where(F.col("size") > limit),
            "crowded",
        )
        if crowded.isEmpty():
            return reduce(DataFrame.union, done, active)
        done.append(active.join(crowded, "cell", "left_anti"))
        sized = active.join(crowded, "cell").select("cell", "size", "node", "unit")
        grown = materialise(_grown(sized, limit, level, chord), "trees")
        tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
        done.append(
            sized.join(grown, "cell", "left_anti")
            .withColumn("tree", tree)
            .withColumn("parts", F.ceil(F.col("size") / limit))
            .select(
                F.concat_ws(
                    "/", "cell", F.lit("alike"), "tree", F.pmod(F.xxhash64("node", "tree"), "parts")
                ).alias("cell"),
                "node",
                "unit",
            )
        )
        active = materialise(_led(sized.join(grown, "cell", "left_semi"), grown), "cells")
        level += 1


def near_duplicate_vectors(
    rows: DataFrame, least: float = 0.98, cell: int = CELL, block: int = BLOCK
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of rows(vec_id, embedding, label).

    Two vectors link if their labels are equal and not null and their cosine, in double
    precision, is at least `least`. Vectors that are null, empty or zero, or hold null or
    non-finite components, link with nothing, and neither do rows without id.

    Equal vectors of one label are one class first. Forests of random-projection trees with
    overlapping splits find the links between classes, and connected components unite them. A link
    never leaves its component, so links are then counted exactly: the classes of
    a component meet in blocks, however many there are. The result has one row per input row;
    a row that repeats an id counts as a vector of its own in `n_links`.
    A row without id has a null component and is kept.
    """
    labelled = F.concat_ws("/", F.length("label"), "label")
    prepared = materialise(
        map_batches(
            rows.select(
                F.col("vec_id").cast("long"), "embedding", F.col("label").cast("string")
            ),
            _units,
            "vec_id long, label string, unit binary",
        ).withColumn("class", F.md5(F.concat(F.encode(labelled, "utf-8"), "unit"))),
        "units",
    )
    units = prepared.where(F.col("unit").isNotNull())
    # ids may repeat with different vectors, so classes have numbers of their own
    classes = materialise(
        units.groupBy("class")
        .agg(
            F.min("vec_id").alias("rep"),
            F.count(F.lit(1)).alias("copies"),
            F.first("label").alias("label"),
            F.first("unit").alias("unit"),
        )
        .withColumn("node", F.xxhash64("class")),
        "classes",
    )

    def link(table):
        ids = np.array(table.column("node").to_pylist(), dtype=np.int64)
        roots = ids
        if len(ids) > 1:
            units = table.column("unit").to_pylist()
            roots = _group_links(ids, _matrix(units), least, range(TREES))
        moved = roots != ids
        return pa.table({"node": pa.array(ids[moved]), "root": pa.array(roots[moved])})

    chord = math.sqrt(max(2 - 2 * least, 1e-12))
    edges = _cells(classes, cell, chord).groupBy("cell").applyInArrow(link, "node long, root long")
    grouped = materialise(connected_components(edges, "node", "root"), "components")

    sizes = materialise(
        grouped.groupBy("component").agg(F.count(F.lit(1)).alias("size")), "sizes"
    )
    members = (
        grouped.join(sizes, "component")
        .join(classes.select("node", "unit", "copies"), "node")
        .withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
        .withColumn("mine", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "component",
            F.least("mine", "other").alias("low"),
            F.greatest("mine", "other").alias("high"),
            "mine",
            "node",
            "unit",
            "copies",
        )
    )

    def count(key, table):
        vectors = _matrix(table.column("unit").to_pylist())
        copies = np.array(table.column("copies").to_pylist(), dtype=np.int64)
        near = vectors @ vectors.T >= least
        np.fill_diagonal(near, False)
        if key[1].as_py() != key[2].as_py():  # links within one side are counted elsewhere
            mine = np.array(table.column("mine").to_pylist())
            near &= mine[:, None] != mine[None, :]
        return pa.table(
            {"node": table.column("node"), "linked": pa.array(near.astype(np.int64) @ copies)}
        )

    counted = (
        members.groupBy("component", "low", "high")
        .applyInArrow(count, "node long, linked long")
        .groupBy("node")
        .agg(F.sum("linked").alias("linked"))
    )
    found = materialise(
        classes.select("class", "node", "rep", "copies")
        .join(grouped, "node", "left")
        .join(counted, "node", "left")
        .select(
            "class",
            "rep",
            F.coalesce("component", "node").alias("whole"),
            (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        ),
        "links",
    )
    smallest = materialise(
        found.groupBy("whole").agg(F.min("rep").alias("component_id")), "smallest"
    )
    known = found.join(smallest, "whole").select("class", "n_links", "component_id")
    linked = units.select("vec_id", "class").join(known, "class").drop("class")
    alone = prepared.where(F.col("unit").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.select("vec_id", "n_links", "component_id").union(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )
