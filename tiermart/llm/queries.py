"""Queries that apply each operator of this subpackage to its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermart.llm.classifier import fit_quality, quality_scores
from tiermart.llm.common import table
from tiermart.llm.html import extract_text
from tiermart.llm.negatives import hard_negatives
from tiermart.llm.packing import pack, token_pieces
from tiermart.llm.pieces import piece_digests
from tiermart.llm.pii import pseudonymised_documents
from tiermart.llm.ranked import ranked_search
from tiermart.llm.records import stored_sequences
from tiermart.llm.rules import fit_rules, rule_verdicts
from tiermart.llm.secrets import scan_secrets
from tiermart.llm.setsketch import NearDuplicates, near_duplicates
from tiermart.llm.urls import apply_url_rules
from tiermart.llm.vectors import near_duplicate_vectors

Query = Callable[[SparkSession, str], DataFrame]

BYTE_TOKENIZER = "byte_bpe_50k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"
PIECE_MODEL = "piece_bpe_32k.model"
WORD_TOKENIZER = "word_bpe_49k.json"
# a fixed key, so that results can be compared between runs; real ones come from a secret store
PII_KEY = b"tiermart example key"

URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def packed_pieces(docs: DataFrame) -> DataFrame:
    pieces = token_pieces(
        docs, public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.path(BYTE_RANKS)
    )
    return pack(pieces)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(table(spark, sf_dir, "documents"))


def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"), least=0.98)


def held_out(doc_id: str = "doc_id"):
    """Documents that no labels are learnt from."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out())
    scores = quality_scores(docs, fit_quality(docs, labels), least=0.3)
    return scores.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return apply_url_rules(table(spark, sf_dir, "pages"), rules)


def op5_near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), NearDuplicates(percent=85, size=3))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rule_verdicts(docs, fit_rules(docs, table(spark, sf_dir, "labels")))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymised_documents(table(spark, sf_dir, "documents"), PII_KEY)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), best=50
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op13_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    stored = stored_sequences(docs, public_tokenizers.path(WORD_TOKENIZER), end_id=1)
    return stored.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES: dict[str, Query] = {
    function.__name__: function
    for function in (
        op1_packing,
        op2_near_vectors,
        op3_quality,
        op4_url_rules,
        op5_near_documents,
        op6_main_text,
        op7_quality_rules,
        op8_pii,
        op9_secrets,
        op10_pieces,
        op11_ranked_search,
        op12_hard_negatives,
        op13_token_records,
    )
}

_RULES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)

SQL: dict[str, str] = {
    "op2_near_vectors": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
),
usable AS (
  SELECT * FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len([x for x in e if x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x for x in e if x <> 0]) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  AND list_cosine_similarity(a.e, b.e) >= 0.98
),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
),
component AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN component USING (vec_id) LEFT JOIN counted USING (vec_id)
""",
    "op4_url_rules": f"""
WITH rules(r_host, r_path, r_verdict) AS (VALUES {_RULES}),
behind AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM behind
)
SELECT page_id, any_value(host) AS host, any_value(path) AS path,
  max_by(r_host || r_path, length(r_host || r_path)) AS rule,
  coalesce(max_by(r_verdict, length(r_host || r_path)), 'allow') AS verdict
FROM parts LEFT JOIN rules
  ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
GROUP BY page_id
""",
    "op5_near_documents": """
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i : i + 2], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i FROM worded WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)
),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
),
component AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN component USING (doc_id) LEFT JOIN sizes USING (doc_id)
""",
    "op11_ranked_search": """
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark
),
listed AS (
  SELECT kind, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM texts
),
sizes AS (SELECT id AS doc_id, len(terms) AS n FROM listed WHERE kind = 'd' AND len(terms) > 0),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
counted AS (
  SELECT kind, id, term, count(*) AS tf FROM (SELECT kind, id, unnest(terms) AS term FROM listed) GROUP BY ALL
),
held AS (SELECT term, count(*) AS df FROM counted WHERE kind = 'd' GROUP BY term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM held, corpus
),
norms AS (SELECT doc_id, 50 + (50 * n * docs) // total AS m FROM sizes, corpus),
scored AS (
  SELECT i.id AS item_id, d.id AS doc_id,
    CAST(sum(w * ((1000000000 * d.tf) // (1000 * d.tf + 20 * m))) AS BIGINT) AS score
  FROM counted i JOIN counted d ON i.kind = 'i' AND d.kind = 'd' AND i.term = d.term
  JOIN weights ON weights.term = i.term JOIN norms ON norms.doc_id = d.id
  GROUP BY 1, 2
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 50
""",
    "op12_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
  AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
""",
}
