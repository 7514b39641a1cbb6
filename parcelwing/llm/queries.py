"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwing.llm import (arrow_tokens, byte_bpe, collocations, differencing, jaccard_join, license_scan, line_rules,
                            merkle, oracles, packing, quality_model, sharding, topk, wrappers)
from parcelwing.llm.common import table


def op1_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    linked = jaccard_join.jaccard_components(table(spark, folder, "documents"), size=3, percent=90)
    return linked.select("doc_id", "n_shingles", "component_id")


def op2_arrow_tokens(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return arrow_tokens.token_files(docs, public_tokenizers.path("word_bpe_49k.json"), end=2, added=True)


def op3_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = line_rules.line_rules(table(spark, folder, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "clean_text")


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = license_scan.license_scan(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.encode_and_decode(table(spark, folder, "documents"),
                                      public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality_model.train(docs, table(spark, folder, "labels"))
    scored = quality_model.score_documents(docs, model)
    return scored.select("doc_id", quality_model.held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op7_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.quantized(table(spark, folder, "embeddings"))
    return topk.top_k(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end=0, added=True)


def op9_wrappers(spark: SparkSession, folder: str) -> DataFrame:
    return wrappers.extract_pages(table(spark, folder, "pages"))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.stratified_shards(table(spark, folder, "documents"), shards=24)


def op11_differencing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return differencing.pack_evenly(docs, public_tokenizers.path("byte_bpe_50k.json"), end=1, added=True)


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(table(spark, folder, "documents"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"), longest=5, least=100, top=2000)


QUERIES = {f.__name__: f for f in (
    op1_jaccard_join, op2_arrow_tokens, op3_line_rules, op4_license_scan, op5_byte_bpe, op6_quality_model, op7_topk,
    op8_packing, op9_wrappers, op10_sharding, op11_differencing, op12_merkle, op13_collocations)}

ORACLE: dict[str, str] = {"op12_merkle": oracles.merkle(), "op13_collocations": oracles.collocations()}
