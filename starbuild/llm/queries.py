"""One query for each operator, over whole tables, and their SQL for DuckDB where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starbuild.llm.bpe import code_report
from starbuild.llm.centroids import ORACLE_SQL as CENTROIDS_SQL
from starbuild.llm.centroids import cluster_report
from starbuild.llm.common import table
from starbuild.llm.conversations import repair_report
from starbuild.llm.decontaminate import ORACLE_SQL as LEAKS_SQL
from starbuild.llm.decontaminate import contaminated
from starbuild.llm.fingerprints import fingerprint_edits
from starbuild.llm.jaccard import ORACLE_SQL as COMPONENTS_SQL
from starbuild.llm.jaccard import near_duplicates
from starbuild.llm.licenses import NOTICES, SPELLINGS, TEXTS, licensed
from starbuild.llm.packing import pack
from starbuild.llm.quality import classify
from starbuild.llm.secrets import RULES, scan
from starbuild.llm.substrings import repeated
from starbuild.llm.tokens import count_tokens
from starbuild.llm.warc import round_trip


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licensed(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = round_trip(table(spark, sf_dir, "pages"))
    return found.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "length"
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated(table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_report(table(spark, sf_dir, "embeddings"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_report(table(spark, sf_dir, "documents"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_quality": op2_quality,
    "op3_token_counts": op3_token_counts,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_fingerprints": op5_fingerprints,
    "op6_secrets": op6_secrets,
    "op7_licenses": op7_licenses,
    "op8_warc": op8_warc,
    "op9_packing": op9_packing,
    "op10_substrings": op10_substrings,
    "op11_centroids": op11_centroids,
    "op12_bpe": op12_bpe,
    "op13_conversations": op13_conversations,
}
ORACLE: dict[str, str] = {
    "op1_decontamination": LEAKS_SQL,
    "op4_ngram_jaccard": COMPONENTS_SQL,
    "op11_centroids": CENTROIDS_SQL,
}
