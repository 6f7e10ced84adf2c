"""Quality classifier: random Fourier features, ridge regression, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermart.llm.common import column, labelled_documents, map_batches, texts_of
from tiermart.llm.textstats import FEATURES, text_stats
from tiermart.session import materialise

LABELLED = 40_000  # labelled documents that the model is fitted on, at most
FOURIER = 256
WIDTH = 4.0  # of the Gaussian kernel, in standard deviations of the statistics
RIDGE = 1e-3  # per row
PARTS = 16  # partitions that the normal equations are summed in


@dataclass
class QualityModel:
    """Score = calibrated value of weights . cos(features . directions + phases)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    # steps of the calibration: a value from knots[i] on, below knots[i + 1], scores levels[i]
    knots: np.ndarray
    levels: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not len(rows):
            return np.zeros(0)
        values = _fourier((rows - self.mean) / self.scale) @ self.weights
        return np.interp(values, self.knots, self.levels)


def _fourier(rows: np.ndarray, seed: int = 5) -> np.ndarray:
    """Random features whose inner products approximate a Gaussian kernel, and a constant."""
    rng = np.random.default_rng(seed)
    directions = rng.standard_normal((rows.shape[1], FOURIER)) / WIDTH
    phases = rng.uniform(0, 2 * np.pi, FOURIER)
    waves = np.sqrt(2 / FOURIER) * np.cos(np.clip(rows, -8, 8) @ directions + phases)
    return np.column_stack([waves, np.ones(len(rows))])


def _feature_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    features = [text_stats(text).features for text in texts_of(batch)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(column(batch, "doc_id"), type=pa.int64()),
            pa.array(features, type=pa.list_(pa.float64())),
            pa.array(column(batch, "label"), type=pa.int32()),
        ],
        names=["doc_id", "features", "label"],
    )


def _summed(rows: DataFrame, function, size: int) -> np.ndarray:
    """Sum over the partitions of `function(features, labels)`, an array of `size` numbers.

    One row per partition reaches the driver; callers bound the number of partitions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                features = np.array(column(batch, "features"), dtype=float)
                total += function(features, np.array(column(batch, "label"), dtype=float))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["total"])

    parts = [bytes(row["total"]) for row in rows.mapInArrow(run, "total binary").collect()]
    return np.sum([np.frombuffer(part) for part in sorted(parts)], axis=0) if parts else np.zeros(size)


def isotonic(values: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and levels of the rising function of `values` nearest to `labels`.

    Pools adjacent violators; each pool is a knot at its mean value. One observation of either kind is
    added to a pool's share, so that levels stay inside 0 and 1.
    """
    order = np.argsort(values, kind="stable")
    pools: list[list[float]] = []  # weight, positives, sum of values
    for value, label in zip(values[order], labels[order]):
        pools.append([1.0, float(label), float(value)])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            weight, positive, total = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], (weight, positive, total))]
    knots = np.array([total / weight for weight, _, total in pools])
    levels = np.array([(positive + 0.5) / (weight + 1) for weight, positive, _ in pools])
    return knots, np.maximum.accumulate(levels)


def fit_quality(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> QualityModel | None:
    """Fit on a bounded sample of labelled documents; None without labels of both kinds.

    The normal equations of the ridge regression are summed per partition. Good and bad documents have
    equal weight in them. The calibration is fitted on the same rows.
    """
    rows = materialise(
        map_batches(
            labelled_documents(docs, labels, bound),
            _feature_batch,
            "doc_id long, features array<double>, label int",
        ).repartition(PARTS, "doc_id"),
        "labelled",
    )
    width = len(FEATURES)

    def moments(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(y), y.sum()], x.sum(axis=0), (x * x).sum(axis=0)])

    # files of the stored sample are small, so a few partitions read them
    sample = rows.coalesce(PARTS)
    total = _summed(sample, moments, 2 + 2 * width)
    n, positive = total[0], total[1]
    if not 0 < positive < n:
        return None
    mean = total[2 : 2 + width] / n
    scale = np.sqrt(np.maximum(total[2 + width :] / n - mean * mean, 0)) + 1e-6
    size = FOURIER + 1

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        waves = _fourier((x - mean) / scale)
        weight = np.where(y == 1, n / (2 * positive), n / (2 * (n - positive)))
        weighted = waves * weight[:, None]
        return np.concatenate([(weighted.T @ waves).ravel(), weighted.T @ (2 * y - 1)])

    summed = _summed(sample, equations, size * size + size)
    matrix, target = summed[: size * size].reshape(size, size), summed[size * size :]
    weights = np.linalg.solve(matrix + RIDGE * n * np.eye(size), target)
    model = QualityModel(mean, scale, weights, np.array([-1.0, 1.0]), np.array([0.0, 1.0]))

    table = sample.toArrow()  # bounded by `bound`
    features = np.array(table.column("features").to_pylist(), dtype=float)
    values = _fourier((features - mean) / scale) @ weights
    labels_seen = np.array(table.column("label").to_pylist(), dtype=float)
    order = np.lexsort((labels_seen, values))
    model.knots, model.levels = isotonic(values[order], labels_seen[order])
    return model


def _scores(model: QualityModel | None, batch: pa.RecordBatch) -> np.ndarray:
    rows = np.array([text_stats(text).features for text in texts_of(batch)])
    return np.full(len(rows), 0.5) if model is None else model.scores(rows)


def quality_scores(docs: DataFrame, model: QualityModel | None, least: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) of docs(doc_id, text).

    `predicted` is 1 for a score of `least` or more. Without a model every score is 0.5. Only the text
    is used. One row per input row, also for null and empty texts, repeated rows and rows
    without id; other columns are ignored.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = _scores(model, batch)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(column(batch, "doc_id"), type=pa.int64()),
                pa.array(scores, type=pa.float64()),
                pa.array((scores >= least).astype(np.int32), type=pa.int32()),
            ],
            names=["doc_id", "score", "predicted"],
        )

    return map_batches(
        docs.select(F.col("doc_id").cast("long"), "text"),
        run,
        "doc_id long, score double, predicted int",
    )


def keep_quality(docs: DataFrame, model: QualityModel | None, least: float = 0.3) -> DataFrame:
    """The rows of docs(text, ...) that score `least` or more, with all their columns."""
    return map_batches(
        docs, lambda batch: batch.filter(pa.array(_scores(model, batch) >= least)), docs.schema
    )
