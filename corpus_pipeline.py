"""The corpus pipeline: quality rules, near-duplicate removal, removal of
repeated passages, mixing of sources, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that the
stage before it kept; all but the last return the columns of ``documents``.
The stages are learned or iterative, so there is no SQL for the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caseload.llm import bwt_dedup, mixing, ngram_join, packing, rules
from caseload.llm.common import read_table, written
from caseload.llm.queries import tokenizer_paths


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned decision list rejects go."""
    return rules.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the smallest id stays."""
    return ngram_join.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id has too are cut from the text."""
    return bwt_dedup.deduplicated(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its place in a training sequence."""
    return packing.packed(docs, **tokenizer_paths())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
