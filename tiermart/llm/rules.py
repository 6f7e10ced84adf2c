"""Quality rules: counts of each text, and an isolation forest on its statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiermart.llm.common import column, labelled_once, map_batches, texts_of
from tiermart.llm.textstats import FEATURES, TextStats, text_stats
from tiermart.session import materialise

TREES = 100
PER_TREE = 256  # rows that a tree draws its random splits from, as usual for isolation forests
BINS = 1 << 16  # of scores, whose counts reach the driver
LOST = 0.002  # share of good labelled documents that the threshold may reject

MIN_WORDS = 50
MAX_REPEATS = 50  # percent


def base_failed(stats: TextStats) -> bool:
    return stats.n_words < MIN_WORDS or 100 * stats.n_repeat_words > MAX_REPEATS * stats.n_words


def _expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    many = 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, many, np.where(n == 2, 1.0, 0.0))


@dataclass
class IsolationForest:
    """Random trees as arrays; node 0 is the root, and a leaf's children are itself.

    A row ends in a leaf, or alone at a node whose range it is outside of. How far it would go on from there
    follows from how many of the rows that the forest is fitted on end there, too.
    """

    feature: np.ndarray  # (tree, node)
    point: np.ndarray
    low: np.ndarray  # range of the node's drawn rows in that feature, a little widened
    high: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: int
    rest: np.ndarray  # (tree, node, alone): expected path from there on
    fitted: int  # rows that the forest is fitted on

    @classmethod
    def grow(cls, rows: np.ndarray, seed: int = 0) -> "IsolationForest":
        """A forest fitted on these rows."""
        forest = cls.split(rows, seed)
        return forest.weighed(forest.masses(rows), len(rows))

    @classmethod
    def split(cls, rows: np.ndarray, seed: int = 0) -> "IsolationForest":
        """Random splits in the ranges of rows that each tree draws from these; nothing is counted yet."""
        rng = np.random.default_rng(seed)
        per_tree = min(PER_TREE, len(rows))
        depth = max(1, int(np.ceil(np.log2(max(per_tree, 2)))))
        size = 2 ** (depth + 1)
        shape = (TREES, size)
        forest = cls(
            np.zeros(shape, dtype=np.int64), np.zeros(shape), np.zeros(shape), np.zeros(shape),
            np.zeros(shape, dtype=np.int64), np.zeros(shape, dtype=np.int64),
            depth, np.zeros((*shape, 2)), 0,
        )
        for tree in range(TREES):
            chosen = rows[rng.choice(len(rows), per_tree, replace=False)]
            forest._grow(tree, chosen, rng)
        return forest

    def _grow(self, tree: int, rows: np.ndarray, rng: np.random.Generator) -> None:
        waiting, used = [(0, rows, 0)], 1
        while waiting:
            node, rows, depth = waiting.pop()
            least, most = rows.min(axis=0), rows.max(axis=0)
            varied = np.flatnonzero(most > least)
            if depth == self.depth or not len(varied):
                self.left[tree, node] = self.right[tree, node] = node
                continue
            feature = rng.choice(varied)
            a, b = least[feature], most[feature]
            point = rng.uniform(a, b)
            below = rows[:, feature] < point
            if not below.any():
                below = rows[:, feature] <= a
            self.feature[tree, node], self.point[tree, node] = feature, point
            self.low[tree, node], self.high[tree, node] = a - 0.1 * (b - a), b + 0.1 * (b - a)
            self.left[tree, node], self.right[tree, node] = used, used + 1
            waiting += [(used, rows[below], depth + 1), (used + 1, rows[~below], depth + 1)]
            used += 2

    def _ends(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each tree, the node where every row ends, whether alone, and the path to there."""
        every = np.arange(len(rows))
        for tree in range(TREES):
            node = np.zeros(len(rows), dtype=np.int64)
            path = np.zeros(len(rows))
            going = np.ones(len(rows), dtype=bool)
            alone = np.zeros(len(rows), dtype=np.int64)
            for _ in range(self.depth + 1):
                left, right = self.left[tree, node], self.right[tree, node]
                going &= left != node
                if not going.any():
                    break
                value = rows[every, self.feature[tree, node]]
                path[going] += 1
                inside = (value >= self.low[tree, node]) & (value <= self.high[tree, node])
                alone[going & ~inside] = 1
                going &= inside
                node = np.where(going, np.where(value < self.point[tree, node], left, right), node)
            yield node, alone, path

    def masses(self, rows: np.ndarray) -> np.ndarray:
        """(tree, node, alone): how many rows end there; masses of several sets of rows add up."""
        size = self.feature.shape[1]
        found = [np.bincount(2 * node + alone, minlength=2 * size) for node, alone, _ in self._ends(rows)]
        return np.array(found).reshape(TREES, size, 2)

    def weighed(self, masses: np.ndarray, fitted: int) -> "IsolationForest":
        """The forest fitted on so many rows, which end as `masses` tells."""
        return replace(self, rest=_expected_path(masses), fitted=fitted)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly scores from 0 to 1: 2 to the minus mean path over the expected path."""
        total = np.zeros(len(rows))
        for rest, (node, alone, path) in zip(self.rest, self._ends(rows)):
            total += path + rest[node, alone]
        usual = max(float(_expected_path(self.fitted)), 1e-9)
        return 2.0 ** (-(total / TREES) / usual)


@dataclass
class QualityRules:
    """The forest, and the score from which a document is rejected."""

    forest: IsolationForest | None
    threshold: float

    def rejected(self, rows: np.ndarray) -> np.ndarray:
        if self.forest is None or not len(rows):
            return np.zeros(len(rows), dtype=bool)
        return self.forest.scores(rows) >= self.threshold


def _feature_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = [
        (doc_id, stats.features)
        for doc_id, stats in zip(column(batch, "doc_id"), map(text_stats, texts_of(batch)))
        if not base_failed(stats)
    ]
    kinds = (pa.int64(), pa.list_(pa.float64()))
    return pa.RecordBatch.from_arrays(
        [pa.array([row[i] for row in rows], type=kind) for i, kind in enumerate(kinds)],
        names=["doc_id", "features"],
    )


def _matrix(values: list) -> np.ndarray:
    return np.array(values, dtype=float).reshape(-1, len(FEATURES))


def fit_rules(docs: DataFrame, labels: DataFrame) -> QualityRules:
    """Fit the forest and its threshold on all labelled documents.

    The forest is that of the documents with label 1, the usual ones: its trees draw their random splits from some
    of these, as isolation forests do, and then all of them are counted where they end. The threshold is
    the one with the fewest wrong verdicts on all labelled documents among those that reject at most `LOST` of
    the documents with label 1, in the middle of the widest such gap. Documents that fail the base rules take no part. Without
    documents of label 1 there is no forest, and without those of label 0 no threshold:
    nothing is rejected.
    """
    # statistics meet the labels, so that no text is moved
    statistics = map_batches(
        docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text"),
        _feature_batch,
        "doc_id long, features array<double>",
    )
    rows = materialise(statistics.join(labelled_once(labels), "doc_id"), "labelled")
    good = rows.where("label = 1")
    n, n_good = rows.agg(F.count(F.lit(1)), F.count_if(F.col("label") == 1)).first()
    if not n_good:
        return QualityRules(None, np.inf)
    # what all trees together draw their splits from
    some = good.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id", "features").limit(TREES * PER_TREE)
    drawn = _matrix(some.toArrow().column("features").to_pylist())
    # the order of collected rows may change between runs
    forest = IsolationForest.split(drawn[np.lexsort(drawn.T)])
    forest = forest.weighed(_masses(good, forest), n_good)
    if n == n_good:
        return QualityRules(forest, np.inf)
    return QualityRules(forest, _threshold(_scored(rows, forest)))


def _masses(rows: DataFrame, forest: IsolationForest) -> np.ndarray:
    """The masses of all rows(features), added up; as many numbers as the forest has places reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(forest.rest.shape, dtype=np.int64)
        for batch in batches:
            total += forest.masses(_matrix(column(batch, "features")))
        places = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(places), pa.array(total.ravel()[places])], names=["place", "n"]
        )

    found = rows.select("features").mapInArrow(run, "place long, n long")
    table = found.groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(forest.rest.size, dtype=np.int64)
    total[table.column("place").to_numpy()] = table.column("n").to_numpy()
    return total.reshape(forest.rest.shape)


def _scored(rows: DataFrame, forest: IsolationForest) -> DataFrame:
    """(score, good, bad): how many rows(features, label) of either label have a score."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = forest.scores(_matrix(column(batch, "features")))
        return pa.RecordBatch.from_arrays(
            [pa.array(scores), batch.column(batch.schema.get_field_index("label"))], names=["score", "label"]
        )

    found = map_batches(rows.select("features", "label"), run, "score double, label int")
    return found.groupBy("score").agg(
        F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") != 1).alias("bad")
    )


def _threshold(scored: DataFrame) -> float:
    """The threshold for scored(score, good, bad), see `fit_rules`.

    Counts of bins of scores tell what lies before and behind each bin; running sums inside the bins do the rest.
    """
    scored = materialise(
        scored.withColumn("bin", F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1))), "scored"
    )
    bins = sorted(
        scored.groupBy("bin").agg(F.sum("good"), F.sum("bad"), F.min("score")).collect()
    )  # at most BINS
    good, bad = (sum(row[i] for row in bins) for i in (1, 2))
    known, behind, before = [], good, 0
    for row, following in zip(bins, [*bins[1:], None]):
        behind -= row[1]
        # a threshold after a row rejects the rows behind it; bins in which none may do so are left out
        if behind <= LOST * good:
            known.append((row[0], behind + row[1], before, following and following[3]))
        before += row[2]
    places = scored.sparkSession.createDataFrame(known, "bin long, behind long, before long, following double")
    order = Window.partitionBy("bin").orderBy("score")
    lost = F.col("behind") - F.sum("good").over(order)
    best = (
        scored.join(F.broadcast(places), "bin")
        .withColumn("lost", lost)
        .withColumn("wrong", F.col("lost") + F.col("before") + F.sum("bad").over(order))
        .withColumn("next", F.coalesce(F.lead("score").over(order), "following"))
        .where((F.col("lost") <= LOST * good) & F.col("next").isNotNull())
        .orderBy("wrong", F.desc(F.col("next") - F.col("score")), "score")
        .first()
    )
    if best is None or best.wrong >= bad:
        return np.inf
    return (best.score + best.next) / 2


def rule_verdicts(docs: DataFrame, rules: QualityRules) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    anomaly, kept) of docs(doc_id, text).

    `anomaly` is the forest's score, 0 without a forest. One row per input row, also for repeated
    rows and rows without id; a null text has no words; other columns are ignored.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        stats = [text_stats(text) for text in texts_of(batch)]
        rows = np.array([s.features for s in stats]).reshape(-1, len(FEATURES))
        scores = rules.forest.scores(rows) if rules.forest else np.zeros(len(rows))
        failed = [base_failed(s) for s in stats]
        counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        columns = {"doc_id": pa.array(column(batch, "doc_id"), type=pa.int64())}
        columns |= {n: pa.array([getattr(s, n) for s in stats], type=pa.int64()) for n in counts}
        columns["base_failed"] = pa.array(failed, type=pa.bool_())
        columns["anomaly"] = pa.array(scores, type=pa.float64())
        columns["kept"] = pa.array(
            [not bad and score < rules.threshold for bad, score in zip(failed, scores)],
            type=pa.bool_(),
        )
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return map_batches(
        docs.select(F.col("doc_id").cast("long"), "text"),
        run,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, anomaly double, kept boolean",
    )


def keep_good(docs: DataFrame, rules: QualityRules) -> DataFrame:
    """The rows of docs(text, ...) that the rules keep, unchanged, with all their columns."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        stats = [text_stats(text) for text in texts_of(batch)]
        rows = np.array([s.features for s in stats]).reshape(-1, len(FEATURES))
        bad = rules.rejected(rows) | np.array([base_failed(s) for s in stats], dtype=bool)
        return batch.filter(pa.array(~bad))

    return map_batches(docs, run, docs.schema)
