"""A corpus pipeline: quality rules, quality classifier, near-duplicates, PII, packing.

Each stage is a function of (spark, docs, sf_dir). Its result is written as Parquet and read again as the
next one's docs; all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tiermart.llm.classifier import fit_quality, keep_quality
from tiermart.llm.common import table
from tiermart.llm.pii import pseudonymise_checked
from tiermart.llm.queries import PII_KEY, packed_pieces
from tiermart.llm.rules import fit_rules, keep_good
from tiermart.llm.setsketch import NearDuplicates, keep_one
from tiermart.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, fit_rules(docs, table(spark, sf_dir, "labels")))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without labelled documents of both kinds among what is left, all score 0.5 and stay."""
    return keep_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, NearDuplicates(percent=80, size=5))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pseudonymise_checked(docs, PII_KEY)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed_pieces(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("pii", pii),
    ("packing", packing),
]

# models, surrogates and token ids have no SQL; tests/llm/test_llm_queries.py follows each stage instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a data folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
