import random
import re

import numpy as np
import pytest

from tiermart.llm import setsketch
from tiermart.llm.setsketch import NearDuplicates, keep_one, likely, minima, near_duplicates, registers, shingles
from tiermart.session import materialise

SCHEMA = "doc_id long, text string, kept string, n_shingles int, node int"


def brute_set(text, size):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def expected(rows, rule):
    """Compare everything with everything."""
    sets = [brute_set(t, rule.size) for _, t in rows]
    n = len(rows)
    near = [[j for j in range(n) if j != i and rows[i][0] is not None and rows[j][0] is not None and (
        (sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= rule.percent * len(sets[i] | sets[j])) or rows[i][0] == rows[j][0])] for i in range(n)]
    out = []
    for i in range(n):
        seen, waiting = {i}, [i]
        while waiting:
            for j in near[waiting.pop()]:
                if j not in seen:
                    seen.add(j)
                    waiting.append(j)
        smallest = None if rows[i][0] is None else min(rows[j][0] for j in seen)
        out.append((rows[i][0], len(sets[i]), smallest, smallest == rows[i][0]))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(3000)]
    texts = []
    for group in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 150))]
        for _ in range(rng.choice([1, 1, 2, 4])):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2, 4])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
    dense = [rng.choice(vocabulary) for _ in range(120)]
    for _ in range(60):  # a large group, some of it only by chains
        words = list(dense)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    rng.shuffle(texts)
    rows = list(enumerate(texts, 1))
    rows += [(900, None), (901, ""), (902, "  \n"), (903, "One two"), (904, "one  TWO"), (905, "É x"), (906, "é x"), (907, "one"), (908, "x " * 9000), (909, "x " * 4000)]
    rows += [(None, texts[0]), (None, None), rows[0], (2, texts[9])]
    return rows


@pytest.mark.parametrize("rule", [NearDuplicates(85, 3), NearDuplicates(80, 5)])
def test_against_all_pairs(spark, rule):
    rows = corpus(rule.size)
    frame = spark.createDataFrame([(*r, "k", 1, 1) for r in rows], SCHEMA)
    got = near_duplicates(frame, rule)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == [
        (a, b, c, True if a is None else d) for a, b, c, d in expected(rows, rule)
    ]


def test_blocks_give_the_same(spark, monkeypatch):
    rule = NearDuplicates(85, 3)
    rows = corpus(7)
    frame = spark.createDataFrame([(*r, "k", 1, 1) for r in rows], SCHEMA)
    monkeypatch.setattr(setsketch, "BLOCK", 8)
    assert sorted(map(tuple, near_duplicates(frame, rule).collect()), key=repr) == [
        (a, b, c, True if a is None else d) for a, b, c, d in expected(rows, rule)
    ]


def test_no_rows_and_only_empty_ones(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    frame = spark.createDataFrame([(1, None, "", 1, 1), (2, "", "", 1, 1)], SCHEMA)
    assert sorted(map(tuple, near_duplicates(frame).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_keep_one(spark):
    text = " ".join("abcdefghij")
    rows = [(1, text, "a", 1, 1), (2, text, "b", 1, 1), (3, "other", "c", 1, 1), (3, "other", "c", 1, 1), (None, text, "d", 1, 1), (None, text, "d", 1, 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    kept = keep_one(frame)
    assert kept.schema == frame.schema
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([rows[0], rows[2], rows[4], rows[5]], key=repr)


def test_likelihood_finds_the_similarity():
    """Sketches on both sides of a similarity, and the maximum of the likelihood itself."""
    rng = np.random.default_rng(0)
    estimates, truth = [], []
    for _ in range(150):
        shared, a, b = rng.integers(50, 2000), rng.integers(0, 500), rng.integers(0, 500)
        values = rng.integers(0, 2**64, shared + a + b, dtype=np.uint64)
        left, right = values[: shared + a], np.concatenate([values[:shared], values[shared + a :]])
        x, y = registers(minima(left)).astype(int), registers(minima(right)).astype(int)
        counts = [np.array([n]) for n in ((x > y).sum(), (x < y).sum(), len(left), len(right))]
        steps = [t for t in np.arange(0.005, 1, 0.005) if likely(t, *counts)[0]]
        estimates.append(max(steps, default=0))
        assert steps == [t for t in np.arange(0.005, 1, 0.005) if t <= estimates[-1]]
        truth.append(shared / (shared + a + b))
    errors = np.array(estimates) - truth
    assert abs(errors.mean()) < 0.01 and errors.std() < 0.045


def test_minima_of_a_union():
    values = np.random.default_rng(1).integers(0, 2**64, 900, dtype=np.uint64)
    assert (minima(values) == np.minimum(minima(values[:400]), minima(values[300:]))).all()


def test_shingles():
    assert len(shingles("a b c d", 3)) == 2 and len(shingles("a b", 3)) == 1 and len(shingles(" ", 3)) == 0
    assert len(shingles("a b c a b c", 3)) == 3
    assert (shingles("A b", 3) == shingles("a B", 3)).all() and (shingles("a b", 2) != shingles("b a", 2)).all()


def test_bands_follow_from_the_threshold():
    assert [(r.bands, r.rows) for r in (NearDuplicates(85, 3), NearDuplicates(80, 5), NearDuplicates())] == [(21, 6), (25, 5), (25, 5)]
    for percent in range(10, 101):
        rule = NearDuplicates(percent)
        assert rule.missed(rule.rows) < 1e-4 and rule.bands * rule.rows <= setsketch.REGISTERS


def test_lone_pairs_at_the_threshold_share_a_band():
    rng = np.random.default_rng(5)
    rule, missed = NearDuplicates(80, 5), {5: 0, 6: 0}
    for _ in range(6000):
        values = rng.integers(0, 2**64, 100, dtype=np.uint64)  # 80 of 100 in common
        same = registers(minima(values[:90])) == registers(minima(np.concatenate([values[:80], values[90:]])))
        for rows in missed:
            used = setsketch.REGISTERS // rows * rows
            missed[rows] += not same[:used].reshape(-1, rows).all(axis=1).any()
    assert missed[rule.rows] <= 2 < missed[6]


def test_texts_go_to_python_in_small_batches(spark, monkeypatch):
    """Whatever the session allows; the session's own setting is back afterwards."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen = spark.conf.get(setting), set()

    def kept(df, name):
        seen.add(df.sparkSession.conf.get(setting))
        return materialise(df, name)

    monkeypatch.setattr(setsketch, "materialise", kept)
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "x y z")], "doc_id long, text string")
    found = setsketch.near_duplicates(docs)
    assert seen == {"2m"} and spark.conf.get(setting) == before
    assert {(r.doc_id, r.component_id) for r in found.collect()} == {(1, 1), (2, 1), (3, 3)}
