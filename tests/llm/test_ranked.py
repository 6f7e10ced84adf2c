import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tiermart.llm import ranked
from tiermart.llm.ranked import _impacts, _peaks, ranked_search, terms_of

DOCS = "doc_id long, text string, rank int, score string, shard long, term string"
ITEMS = "item_id long, text string, rank string, block int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def listed(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [t.encode() for t in TERM.findall(lower)]


def brute(docs, items, best):
    """Every score in plain integers."""
    counted = [(i, Counter(listed(text))) for i, text in docs if listed(text)]
    n, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, {}).update(dict.fromkeys(listed(text)))
    rows = []
    for item, terms in wanted.items():
        found = []
        for doc, counts in counted:
            m = 50 + 50 * counts.total() * n // total
            score = 0
            for t in terms:
                if counts[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * counts[t] // (1000 * counts[t] + 20 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        for rank, (score, missing, doc) in enumerate(sorted(found)[:best], 1):
            rows.append((item, rank, None if missing else doc, -score))
    return sorted(rows, key=repr)


def search(spark, docs, items, best=3):
    d = spark.createDataFrame([(*row, 1, "s", 2, "t") for row in docs], DOCS)
    i = spark.createDataFrame([(*row, "r", 3) for row in items], ITEMS)
    found = ranked_search(d.repartition(3), i, best)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("aZ09 _-.\t\n\x7f\x85\xa0éÉß漢@`[{"), max_size=30))
def test_terms(text):
    assert terms_of(text) == listed(text)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(st.integers(1, 30), st.integers(0, 300)), min_size=1, max_size=40),
    st.integers(1, 10**6),
)
def test_peaks_hold_the_largest_impact(pairs, total):
    counts = np.array([c for c, _ in pairs], dtype=np.int64)
    lengths = counts + np.array([more for _, more in pairs], dtype=np.int64)
    top = _peaks(counts, lengths)
    assert _impacts(top[0], top[1], 100, total).max() == _impacts(counts, lengths, 100, total).max()


@pytest.mark.parametrize("shard, block", [(16_384, 256), (7, 2)])
def test_against_all_scores(spark, monkeypatch, shard, block):
    monkeypatch.setattr(ranked, "SHARD", shard)
    monkeypatch.setattr(ranked, "BLOCK", block)
    draw = np.random.default_rng(5)
    # common words are in nearly every document, rare ones in a few
    words = [f"w{i}" for i in range(60)]
    chance = 1 / np.arange(1, 61) ** 1.2
    docs = [
        (i, " ".join(draw.choice(words, size=draw.integers(1, 60), p=chance / chance.sum())))
        for i in range(150)
    ]
    docs += [(200 + i, docs[3][1]) for i in range(20)]  # ties
    items = [(i, " ".join(draw.choice(words, size=8))) for i in range(7)]
    assert search(spark, docs, items) == brute(docs, items, 3)


def test_odd_rows(spark):
    long_text = "alpha beta " * 30_000
    docs = [
        (1, None), (2, ""), (3, "..."), (None, "alpha gamma"), (4, "ALPHA beta, gamma"), (4, "ALPHA beta, gamma"),
        (5, long_text), (6, "delta"), (7, "Été alpha"), (8, "alpha gamma"),
    ]
    items = [(1, "alpha beta beta"), (2, None), (3, ""), (4, "none"), (None, "delta"), (5, "été"), (5, "gamma")]
    assert search(spark, docs, items, 5) == brute(docs, items, 5)


def test_no_rows(spark):
    assert search(spark, [], [(1, "a")]) == []
    assert search(spark, [(1, "a")], []) == []
    assert search(spark, [(1, None)], [(1, "a")]) == []
