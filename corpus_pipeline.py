"""The corpus pipeline: documents through quality, line rules and near-duplicates into packed sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwing.llm.common import plain, stored, table
from parcelwing.llm.jaccard_join import one_per_group
from parcelwing.llm.line_rules import line_rules
from parcelwing.llm.packing import pack
from parcelwing.llm.quality_model import keep_good


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; those that stay lose their frequent lines.

    The verdicts are stored before they are used: a filter on them would be
    moved below the join and compute the figures of each text many times over.
    """
    columns = [plain(c) for c in docs.columns]
    cleaned = [F.col("clean_text").alias("text") if c == "text" else F.col(plain(c)) for c in docs.columns]
    judged = stored(line_rules(docs).select(*cleaned, F.col("kept").alias("_kept")), "judged")
    return judged.filter("_kept").select(columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, similarity 0.8."""
    return one_per_group(docs, size=5, percent=80)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, placed in sequences of 2048 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end=0, added=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("best_fit_packing", best_fit_packing),
]

# a trained model and a packing plan have no SQL; tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
