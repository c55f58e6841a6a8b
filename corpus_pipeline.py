"""Preparing a corpus in five stages, each written as a table and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from freshet.llm import decontaminate, factorisation, mixture, order_minhash, quality_rules, toxicity
from freshet.llm.common import crc_fold, table
from freshet.session import cut_lineage


def quality_rule_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what passes the base rules and the log-likelihood threshold, fitted on these documents."""
    ratios = quality_rules.fit(docs, quality_rules.trusted_ids(table(spark, sf_dir, "labels")))
    return quality_rules.accepted(docs, ratios)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the factorisation machine gives a quality of 0.7 or more."""
    model = factorisation.fit(toxicity.sample(docs, table(spark, sf_dir, "labels"), "quality", crc_fold("doc_id", 4) != 2))
    return docs.where(factorisation.probability(docs, model) >= 0.7)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each class of near copies."""
    return order_minhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how often (copies) and the words taken."""
    return mixture.mixed_documents(docs)


STAGES = [
    ("quality rules", quality_rule_stage),
    ("quality classifier", quality_classifier_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixture", mixture_stage),
]
#: Two stages are models; the pipeline is tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
