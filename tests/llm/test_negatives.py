import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiermart.llm import negatives
from tiermart.llm.negatives import _first, _scores, hard_negatives

ROWS = "vec_id long, embedding array<double>, label int, row string, anchor int, score double, slot int"


def brute(rows, anchor):
    """All scores in plain integers."""
    used = []
    for vec_id, values, label in rows:
        if vec_id is None or label is None or values is None:
            continue
        if any(v is None or not math.isfinite(v) for v in values):
            continue
        used.append((vec_id, label, [math.floor(256 * v) for v in values]))
    out = []
    for a, (anchor_id, label, vector) in enumerate(used):
        if not anchor(anchor_id):
            continue
        scored = [
            (-sum(x * y for x, y in zip(vector, v)), i, k == label)
            for n, (i, k, v) in enumerate(used)
            if n != a and len(v) == len(vector)
        ]
        scored.sort()
        for down, positive, _ in [s for s in scored if s[2]][:5]:
            inside = [s for s in scored if not s[2] and 80 * -down <= 100 * -s[0] <= 100 * -down]
            for rank, (d, negative, _) in enumerate(inside[:5], 1):
                out.append((anchor_id, positive, rank, negative, -down, -d))
    return sorted(out)


def mined(spark, rows, every=10):
    df = spark.createDataFrame([(*r, "x", 1, 0.5, 2) for r in rows], ROWS).repartition(3)
    found = hard_negatives(df, F.col("vec_id") % every == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("blocks", [(32_768, 16_384, 256), (3, 17, 2)])
def test_against_all_scores(spark, monkeypatch, blocks):
    for name, size in zip(("ANCHORS", "ROWS", "PART"), blocks):
        monkeypatch.setattr(negatives, name, size)
    draw = np.random.default_rng(3)
    centre = draw.normal(size=6)
    # a third of all rows has one label; coarse values make ties
    rows = [
        (i, [float(v) for v in np.round(centre + 0.4 * draw.normal(size=6), 1)], 0 if i % 3 == 0 else int(draw.integers(1, 4)))
        for i in range(160)
    ]
    rows += [(200 + i, rows[5][1], rows[5][2] + 1) for i in range(12)]
    want = brute(rows, lambda i: i % 10 == 0)
    assert want and mined(spark, rows) == want


def test_odd_rows(spark):
    a, b = [1.0, 0.5], [0.9, 0.6]
    rows = [
        (10, a, 1), (10, a, 1), (11, b, 1), (12, b, 2), (13, a, 2), (None, a, 2), (14, None, 2), (15, a, None),
        (16, [1.0, None], 2), (17, [math.inf, 1.0], 2), (18, [math.nan, 1.0], 2), (19, [], 2), (20, [], 1), (21, [], 1),
        (30, [1.0, 0.5, 2.0], 1), (31, [1.0, 0.5, 2.0], 2), (40, [-3.0, 0.0], 7), (41, [3.0, 0.1], 7), (42, [-1.0, 0.0], 8),
        (50, [0.0, 0.0], 9), (51, [1.0, 1.0], 9),
    ]
    want = brute(rows, lambda i: i % 10 == 0)
    assert want and mined(spark, rows) == want


def test_no_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []  # no anchor
    assert mined(spark, [(10, [1.0], 1), (2, [1.0], 2)]) == []  # no positive


def test_large_products_stay_exact():
    big = float(2**30 + 1)
    assert _scores(np.array([[big, 1.0]]), np.array([[big, 3.0]]))[0, 0] == (2**30 + 1) ** 2 + 3
    with pytest.raises(ValueError):
        _scores(np.array([[1e10]]), np.array([[1e10]]))


def test_first_of_ties():
    scores = np.array([5, 7, 7, 1, 7, 5])
    assert _first(scores, np.arange(6), 2).tolist() == [1, 2]
    assert _first(scores, np.array([0, 3, 4, 5]), 3).tolist() == [4, 0, 5]
