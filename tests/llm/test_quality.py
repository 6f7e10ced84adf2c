import random

import numpy as np

from tiermart.llm.classifier import fit_quality, isotonic, keep_quality, quality_scores
from tiermart.llm.common import labelled_sample
from tiermart.llm import rules as quality_rules
from tiermart.llm.rules import LOST, IsolationForest, _threshold, fit_rules, keep_good, rule_verdicts
from tiermart.llm.textstats import text_stats

DOCS = "doc_id long, text string, lang string, score string, features int, kept int"


def brute(text):
    """Counts of the rules, word by word."""
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, dup, seen = text.split("\n"), 0, set()
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    marked = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(marked), failed


def corpus(n, seed=0):
    """Ordinary texts, and ones with signs all over."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("aeioulnrst", k=rng.randint(2, 9))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(60, 200))]
        good = i % 4 > 0
        text = " ".join(words if good else [w + rng.choice(["###", "%%%", "&&&"]) for w in words])
        docs.append((i, text.capitalize() + ".", "en", "x", 1, 0))
        labels.append((i, int(good)))
    return docs, labels


EDGES = ["", None, " \t\n ", "a b c a b c", "a b c a b c a b c " * 20, "x\ny\nx\n \n \nx", "é ü\xa0z\u2003w", "w" * 9000,
         "one two three four\x0bfive\x0csix\r\nseven", "<#> & | * $ % >", "a a a a", "a b a b a b a"]


def test_counts_against_brute_force(spark):
    rows = [(i, t, "l", "s", 1, 1) for i, t in enumerate(EDGES)] + [(None, "a b", "", "", 0, 0), (3, EDGES[3], "", "", 0, 0)]
    rules = fit_rules(spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, quality int"))
    got = rule_verdicts(spark.createDataFrame(rows, DOCS), rules).collect()
    want = [(r[0], *brute(r[1])) for r in rows]
    assert sorted((tuple(g)[:7] for g in got), key=repr) == sorted(want, key=repr)
    assert all(g.kept == (not g.base_failed) for g in got)


def test_counts_of_random_texts():
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choices("ab \n\t#.é", k=rng.randint(0, 80)))
        s = text_stats(text)
        assert (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words) == brute(text)[:5]


def test_forest_rejects_unusual_documents_and_keeps_the_others(spark):
    docs, labels = corpus(600)
    frame = spark.createDataFrame(docs, DOCS)
    train = spark.createDataFrame([(i, q, 0) for i, q in labels if i < 300], "doc_id long, quality int, text int")
    rules = fit_rules(frame, train)
    verdicts = {r.doc_id: r.kept for r in rule_verdicts(frame, rules).collect()}
    truth = dict(labels)
    assert np.mean([verdicts[i] == bool(truth[i]) for i in range(300, 600)]) > 0.98
    kept = keep_good(frame, rules)
    assert kept.schema == frame.schema
    assert {r.doc_id for r in kept.collect()} == {i for i, k in verdicts.items() if k}


def test_forest_scores_rise_with_distance():
    rng = np.random.default_rng(0)
    rows = rng.standard_normal((400, 4))
    scores = IsolationForest.grow(rows).scores(np.array([[0.0] * 4, [2.5] * 4, [9.0] * 4]))
    assert scores[0] < scores[1] < scores[2]
    assert IsolationForest.grow(np.ones((5, 2))).scores(np.ones((1, 2)))[0] <= 1


def test_rules_are_fitted_on_every_labelled_document(spark, monkeypatch):
    """A labelled document counts in the forest and in the threshold, however few the trees draw from."""
    docs, labels = corpus(200)
    monkeypatch.setattr(quality_rules, "PER_TREE", 1)
    monkeypatch.setattr(quality_rules, "LABELLED", 20, raising=False)
    fitted = fit_rules(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int")
    ).forest
    usual = {r.doc_id for r in rule_verdicts(spark.createDataFrame(docs, DOCS), quality_rules.QualityRules(None, np.inf)).collect() if not r.base_failed}
    assert fitted.fitted == len(usual & {i for i, q in labels if q == 1}) > 20


def brute_threshold(scores, good):
    """The same by a look at every gap."""
    values = sorted(set(scores))
    best = None
    for a, b in zip(values, values[1:]):
        lost = sum(g for s, g in zip(scores, good) if s > a)
        wrong = lost + sum(not g for s, g in zip(scores, good) if s <= a)
        if lost <= LOST * sum(good) and (best is None or (-wrong, b - a) > best[0]):
            best = (-wrong, b - a), (a + b) / 2
    return best[1] if best and -best[0][0] < sum(not g for g in good) else np.inf


def test_threshold_against_brute_force(spark):
    rng = np.random.default_rng(4)
    for bins, spread in ((1, 0.3), (8, 0.3), (1 << 16, 0.01), (1 << 16, 0.6)):
        good = rng.random(900) < 0.7
        scores = np.round(np.clip(0.4 + spread * rng.random(900) + 0.2 * ~good, 0, 1), 3)
        rows = [(float(s), int(g), int(not g)) for s, g in zip(scores, good)]
        counted = spark.createDataFrame(rows, "score double, good long, bad long").groupBy("score").sum("good", "bad")
        quality_rules.BINS, before = bins, quality_rules.BINS
        try:
            found = _threshold(counted.toDF("score", "good", "bad"))
        finally:
            quality_rules.BINS = before
        assert found == brute_threshold(scores.tolist(), good.tolist())


def test_classifier(spark):
    docs, labels = corpus(800, seed=1)
    docs += [(900, None, "", "", 0, 0), (901, "", "", "", 0, 0), (None, "a b", "", "", 0, 0), (5, docs[5][1], "", "", 0, 0), (902, "w" * 100_000, "", "", 0, 0)]
    frame = spark.createDataFrame(docs, DOCS)
    train = spark.createDataFrame(
        [(i, q, 0) for i, q in labels if i < 400] + [(None, 1, 0), (3, None, 0), (2, 1, 0)], "doc_id long, quality int, score int"
    )
    model = fit_quality(frame, train)
    got = quality_scores(frame, model).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    truth = dict(labels)
    right = [r.predicted == truth[r.doc_id] for r in got if r.doc_id is not None and 400 <= r.doc_id < 800]
    assert np.mean(right) > 0.97
    kept = keep_quality(frame, model)
    assert kept.schema == frame.schema and kept.count() == sum(r.predicted for r in got)


def test_classifier_without_labels(spark):
    frame = spark.createDataFrame([(1, "a b", "", "", 0, 0)], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = fit_quality(frame, none)
    assert model is None and quality_scores(frame, model).first().score == 0.5
    assert quality_scores(frame.limit(0), model).collect() == []


def test_isotonic():
    knots, levels = isotonic(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.0, 1.0, 0.0, 1.0]))
    assert (np.diff(knots) > 0).all() and (np.diff(levels) >= 0).all() and len(knots) == 3


def test_labelled_sample_is_bounded_and_has_one_row_per_document(spark):
    labels = spark.createDataFrame([(i % 50, i % 2) for i in range(200)], "doc_id long, quality int")
    got = labelled_sample(labels, 20).collect()
    assert len(got) == 20 == len({r.doc_id for r in got})
