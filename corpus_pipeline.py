"""From raw documents to a training mix: five stages, each stored before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortloom.llm import decontamination, jaccard_join, mixing, quality_rules, secret_scan
from cohortloom.llm.stored import stored
from cohortloom.sources.tables import scan


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the adaptive thresholds keep."""
    return quality_rules.good_documents(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of every class linked by five-word shingles at a similarity of 0.8 or more."""
    return jaccard_join.one_of_each_class(docs, jaccard_join.jaccard_classes(docs, words=5, percent=80))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontamination.without_leaks(docs, scan(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return secret_scan.without_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, in shuffled order."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", keep_good_quality),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("secret_scan", mask_secrets),
    ("source_mixing", mix_sources),
]

# Classes of linked documents and SimHash windows have no practical SQL; tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
