"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir), where docs are the Parquet rows its predecessor wrote,
and all but the last return the columns of ``documents``.  The rows of the last stage are
token pieces with their places in sequences.  SQL cannot express the stages' models, so
ORACLE_SQL is None; the tests hold each stage against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradewind.llm.common import store
from tradewind.llm.mixing import mixed_documents
from tradewind.llm.near_duplicates import distinct_documents
from tradewind.llm.packing import best_fit_packing
from tradewind.llm.personal_data import mask_documents
from tradewind.llm.quality_rules import kept_documents
from tradewind.llm.queries import table, vocabulary

ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return kept_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (shingles of five words, similarity 0.8), once."""
    return distinct_documents(docs, words=5, percent=80)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked."""
    return mask_documents(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces packed into sequences."""
    return best_fit_packing(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("personal data", personal_data_stage),
    ("source mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
