"""From raw documents to encoded ones, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import exact_dedup, mixing, quality_rules, sentencepiece, simhash
from tidewater.llm.common import materialise, table


def rule_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts one stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their fingerprints the one with the smallest id stays."""
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order that holds every source to its weight; all stay."""
    return mixing.mixed(docs)


def encode_in_order(docs: DataFrame) -> DataFrame:
    """Sub-word counts and digests of every document and its ``position`` in
    the mixture, in that order; ``docs`` is read from the mixture's files."""
    return sentencepiece.encode_report(mixing.written_order(docs, "doc_id", "text"), keep=("position",))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sub-word counts and digests of every document, in mixture order."""
    return encode_in_order(docs).drop("position")


STAGES = [
    ("quality_rules", rule_quality),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

# Hashes, fingerprints and sub-word ids have no DuckDB counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``; each result is written below the
    shared folder and read again.  ``position`` counts the rows of the result
    in mixture order."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return encode_in_order(docs)
