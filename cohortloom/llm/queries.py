"""Registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from cohortloom.llm import centroid_clusters, decontamination, filter_audit, jaccard_join, language_id, license_scan
from cohortloom.llm import mixing, quality_rules, secret_scan, sentence_dedup, token_files, warc
from cohortloom.llm import token_counts as tokens
from cohortloom.sources.tables import scan
from cohortloom.sources.workspace import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        # Python workers of a session that was started in another folder find the package, too.
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))
        return build(spark, folder)

    QUERIES[build.__name__] = run
    return run


@query
def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(scan(spark, folder, "documents"))


ORACLES["op1_mixing"] = mixing.ORACLE


@query
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return tokens.token_counts(scan(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = new_folder(spark, "archives")
    warc.write_archives(scan(spark, folder, "pages"), archives)
    return warc.read_archives(spark, archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op3_warc"] = warc.ORACLE


@query
def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_classes(scan(spark, folder, "documents"), words=4, percent=85)


@query
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.leaks(scan(spark, folder, "documents"), scan(spark, folder, "benchmark"))


@query
def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.languages(scan(spark, folder, "documents"))


@query
def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secrets(scan(spark, folder, "documents"))


@query
def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.licenses(scan(spark, folder, "documents"))


@query
def op9_sentence_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = sentence_dedup.without_repeats(scan(spark, folder, "documents"), passages=True)
    return done.select("doc.doc_id", "doc.text", "n_sentences", "n_removed", "words_removed")


@query
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(scan(spark, folder, "documents"))


@query
def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.filter_audit(scan(spark, folder, "documents"), scan(spark, folder, "labels"))


ORACLES["op11_filter_audit"] = filter_audit.ORACLE


@query
def op12_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return centroid_clusters.clusters(scan(spark, folder, "embeddings"))


ORACLES["op12_centroid_clusters"] = centroid_clusters.ORACLE


@query
def op13_token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return token_files.token_files(
        scan(spark, folder, "documents"), new_folder(spark, "token_files"), public_tokenizers.path("word_bpe_49k.json"))
