"""The registered queries against SQL or, where SQL cannot express them, against plain Python."""

import os
import re
import zlib
from html import unescape

import pytest

import __spark_entry__ as entry
import check
import corpus_pipeline
from tiermart.llm.html import main_text
from tiermart.llm.pii import Surrogates, find_entities
from tiermart.llm.queries import PII_KEY, SQL
from test_packing import best_fit
from test_quality import brute
from test_records import brute as all_records
from test_setsketch import expected
from tiermart.llm.setsketch import NearDuplicates

SF_DIR = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"  # where labels of both kinds and secrets are many enough

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the benchmark tables")


def rows(spark, name, sf_dir=SF_DIR):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()


def query(spark, name, sf_dir=SF_DIR):
    return entry.queries()[name](spark, sf_dir)


@pytest.mark.parametrize("name", list(SQL))
def test_sql(spark, name):
    con = check.connect(SF_DIR)
    got = query(spark, name).toArrow()
    assert got.num_rows > 0
    assert check.difference(got, con.sql(entry.oracle_sql()[name]).to_arrow_table()) is None


def test_registered():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14)) and "pipeline" in entry.queries()


def test_packing(spark):
    got = query(spark, "op1_packing").collect()
    documents = rows(spark, "documents")
    assert {r.doc_id for r in got} == {r.doc_id for r in documents}
    lengths = [r.length for r in got]
    assert len({r.sequence_id for r in got}) == best_fit(lengths, 2048)
    for r in got:
        assert 0 <= r.offset and r.offset + r.length <= 2048


def test_quality(spark):
    got = query(spark, "op3_quality", LARGER).collect()
    labels = {r.doc_id: r.quality for r in rows(spark, "labels", LARGER)}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(r.predicted == (r.score >= 0.3) for r in got) and len(got) == len(rows(spark, "documents", LARGER))
    judged = [r.predicted == labels[r.doc_id] for r in got if r.held_out and r.doc_id in labels]
    assert sum(judged) / len(judged) >= 0.97


def test_main_text(spark):
    pages = {r.page_id: r for r in rows(spark, "pages")}
    got = query(spark, "op6_main_text").collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S).group(1)
        plain = " ".join(unescape(re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", article))).split())
        assert r.text == plain == main_text(pages[r.page_id].html) and r.n_chars == len(plain)


def test_rules(spark):
    texts = {r.doc_id: r.text for r in rows(spark, "documents")}
    got = query(spark, "op7_quality_rules").collect()
    assert sorted(tuple(r)[:7] for r in got) == sorted((i, *brute(t)) for i, t in texts.items())
    labels = {r.doc_id: r.quality for r in rows(spark, "labels")}
    judged = [r.kept == labels[r.doc_id] for r in got if not r.base_failed and r.doc_id in labels]
    assert sum(judged) / len(judged) >= 0.95


def test_pii(spark):
    keyed = Surrogates(PII_KEY)
    texts = {r.doc_id: r.text for r in rows(spark, "documents")}
    got = query(spark, "op8_pii").collect()
    assert {r.doc_id: r.text for r in got} == {i: keyed.rewrite(t, find_entities(t)) for i, t in texts.items()}
    assert any(r.n_entities for r in got)
    for r in got:
        assert not {m for m in re.findall(r"\S+@\S+|\b\d{16}\b", texts[r.doc_id]) if m in r.text}


def test_secrets(spark):
    planted = re.compile(r"AKIA[A-Z0-9]{16}|(?<=password=)[0-9a-f]{18}|(?<=token = \")[0-9a-f]{40}")
    want = sorted((r.doc_id, m) for r in rows(spark, "documents", LARGER) for m in planted.findall(r.text or ""))
    got = sorted((r.doc_id, r.finding) for r in query(spark, "op9_secrets", LARGER).collect() if r.is_secret)
    assert got == want


def test_pieces(spark):
    got = query(spark, "op10_pieces").collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in rows(spark, "documents"))


def test_token_records(spark):
    order = sorted((r.doc_id, r.text) for r in rows(spark, "documents"))
    got = sorted(tuple(r) for r in query(spark, "op13_token_records").collect())
    assert got == [(i, start, n, zlib.crc32(ids)) for i, start, n, ids in all_records(order)]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = {r.doc_id: r.quality for r in rows(spark, "labels")}
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = corpus_pipeline.materialise(stage(spark, docs, SF_DIR), name)
        assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        gone = before.keys() - after.keys()
        kept.append(len(after))
        if name != "pii":
            assert all(before[i] == r for i, r in after.items())
        if name == "quality_rules":
            assert all(not brute(r.text)[5] for r in after.values())
            assert all(brute(before[i].text)[5] or labels.get(i) != 1 for i in gone)
        elif name == "quality_classifier":
            assert sum(labels.get(i) == 1 for i in gone) <= 0.02 * len(after)
        elif name == "near_duplicates":
            want = expected([(i, r.text) for i, r in before.items()], NearDuplicates(80, 5))
            assert set(after) == {w[0] for w in want if w[3]}
        else:
            keyed = Surrogates(PII_KEY)
            assert {i: r.text for i, r in after.items()} == {i: keyed.rewrite(r.text, find_entities(r.text)) for i, r in before.items()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in packed} == set(after)
    assert kept[0] < 200 and kept == sorted(kept, reverse=True)


def test_pipeline_of_odd_rows(spark, tmp_path):
    text = "the of and to in that it for was on " * 3
    plain = " ".join(f"{w}{i}" for i, w in enumerate(text.split() * 3))
    odd = [(1, None, "en", "s", 0), (2, "", None, None, None), (None, plain, "en", "s", 1), (3, plain, "en", "s", 1), (3, plain, "en", "s", 1), (4, "w" * 50_000, "en", "s", 2)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for folder, found, labels in (("a", odd, [(3, 1, 0), (None, 0, None), (4, None, 1)]), ("b", [], [])):
        place = tmp_path / folder
        spark.createDataFrame(found, schema).write.parquet(str(place / "documents.parquet"))
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(place / "labels.parquet"))
        got = corpus_pipeline.run(spark, str(place)).collect()
        assert sorted((r.doc_id for r in got), key=str) == ([3, None] if found else [])
