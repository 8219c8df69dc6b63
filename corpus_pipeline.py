"""The corpus pipeline: five stages, each over all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of documents. Every row is
judged, with or without a doc_id of its own; rows without text pass the filters that have nothing to judge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starbuild.llm.common import materialize, table
from starbuild.llm.decontaminate import without_leaks
from starbuild.llm.jaccard import first_of_each
from starbuild.llm.packing import pack
from starbuild.llm.quality import accepted
from starbuild.llm.secrets import redacted


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier does not reject."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group of near duplicates."""
    return first_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets blotted out and n_chars set anew."""
    return redacted(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: the rows of `pack`."""
    return pack(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_first),
    ("benchmark decontamination", drop_leaks),
    ("secret scans", hide_secrets),
    ("best-fit packing", pack_sequences),
]

#: A trained classifier and token ids are beyond SQL; tests/llm compares the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from all of `documents`."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
