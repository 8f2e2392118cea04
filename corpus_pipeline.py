"""A training corpus from raw documents: reject, deduplicate, mix and pack.

Every stage takes (spark, docs, sf_dir) and returns what is left; all but the last keep the
columns of documents. ``run`` writes what a stage returns and gives the next one the copy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from changefeed.llm import bin_slack, divergence, overlap, patricia, pivotal_mix
from changefeed.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are not far from every language."""
    return divergence.kept_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest ``doc_id``."""
    return patricia.without_copies(docs, keep="max")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more the smallest ``doc_id``.

    Candidates are linked by fingerprints (Golay-code keys), or share a band of MinHash values.
    """
    return overlap.without_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; documents come as often as the mix takes them."""
    return pivotal_mix.mixed_documents(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 token ids."""
    return bin_slack.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack_windows", pack_windows),
]

# Fingerprints, hash draws and token ids have no SQL; the tests use plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
