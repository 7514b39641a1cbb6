"""Added tokens inside texts get the ids that an unmodified tokenizer gives them."""

import brute
import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from parcelwing.llm import queries
from parcelwing.llm.tokens import PieceEncoder

TEXTS = ["<|endoftext|> x", "a<|endoftext|>b c", "one two <|startoftext|> three", "x <|ENDOFTEXT|> y", "<|endoftext|>", "a b",
         "lead  <|endoftext|>\n<|endoftext|>", "<| endoftext |> plain", ""]


def library(name, text):
    return Tokenizer.from_file(P.path(name)).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder(name):
    encoder = PieceEncoder(P.path(name), added=True)
    for texts in (TEXTS, TEXTS[::-1]):
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == [library(name, t) for t in texts]


def test_queries(spark, tmp_path):
    from parcelwing.llm.common import importable

    importable(spark)
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    want = [brute.crc(library("word_bpe_49k.json", t) + [2]) for t in TEXTS]
    got = queries.QUERIES["op2_arrow_tokens"](spark, str(tmp_path)).collect()
    assert [r.ids_crc32 for r in sorted(got, key=lambda r: r.doc_id)] == want
    want = [brute.crc(library("byte_bpe_50k.json", t) + [0]) for t in TEXTS]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for packed in (queries.QUERIES["op8_packing"](spark, str(tmp_path)),
                   corpus_pipeline.best_fit_packing(spark, docs, str(tmp_path))):
        assert [r.ids_crc32 for r in sorted(packed.collect(), key=lambda r: r.doc_id)] == want
