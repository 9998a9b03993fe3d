"""The corpus pipeline: language ID, exact dedup, SimHash near-dedup, PII surrogates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import common, exact_dedup, language_id, packing, pii_surrogates, queries, simhash_dedup
from tallyframe.sources.tables import load, materialize


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null text, no letter) go."""
    found = language_id.identify(docs)
    return common.keep_rows(docs, found.select("doc_id", "text_hash", (F.col("lang_pred") != language_id.UNDETERMINED).alias("kept")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    return common.keep_rows(docs, exact_dedup.exact_dedup(docs).select("doc_id", "text_hash", "kept"), once=True)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates the document with the smallest doc_id stays."""
    found = simhash_dedup.simhash_dedup(docs)
    return common.keep_rows(docs, found.select(
        "doc_id", "text_hash", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")), once=True)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts becomes surrogates; n_chars follows a changed text."""
    replaced = pii_surrogates.replace_entities(docs, count="__tf_entities")
    if "n_chars" in docs.columns:
        length = F.when(F.col("__tf_entities") > 0, F.length("text")).otherwise(F.col("n_chars"))
        replaced = replaced.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return replaced.select(*[replaced[f"`{c}`"] for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens."""
    return packing.pack(docs, queries.byte_model())


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("simhash_dedup", simhash_stage),
    ("pii_surrogates", pii_stage),
    ("packing", packing_stage),
]

#: The stages hash, classify and tokenise in ways that SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
