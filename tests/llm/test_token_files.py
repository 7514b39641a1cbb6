"""Arrow token files: zero-copy access, several files, reading back in several tasks."""

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from parcelwing.llm import arrow_tokens
from parcelwing.llm.tokens import LONG_RUN, PieceEncoder

LETTERS = st.sampled_from(list("ab '.\n\t1éßÜ’ж日한ωΣ½²ªµİſK\xa0\x00\x1c\x85́") + ["the ", "'ll", "  ", "<|endoftext|>", "ing"])


@pytest.fixture(scope="module", params=["byte_bpe_50k.json", "word_bpe_49k.json"])
def both(request):
    path = P.path(request.param)
    return PieceEncoder(path, added=True), Tokenizer.from_file(path)


@settings(max_examples=300, deadline=None)
@given(parts=st.lists(LETTERS, max_size=40))
def test_ids_are_the_library_s(both, parts):
    encoder, library = both
    text = "".join(parts)
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_long_runs(both):
    encoder, library = both
    for text in ("x" * LONG_RUN, "a" + " " * 2 * LONG_RUN + "b", "é!" * LONG_RUN, "word " * LONG_RUN):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_sequences(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"text number {k} " * (k % 7)) for k in range(500)], "doc_id long, text string")
    manifest = arrow_tokens.write_sequences(docs.repartition(5), str(tmp_path / "files"), P.path("word_bpe_49k.json"), 2, 16)
    files = manifest.orderBy("part").collect()
    assert len(files) > 1 and sum(f.docs for f in files) == 500
    for one in files:
        file = arrow_tokens.SequenceFile(one.file)
        pairs = [file.sequence(i) for i in range(len(file))]
        pages = {b.address for c in file.table.column("mask").chunks for b in c.flatten().buffers() if b}
        assert all(len(ids) == len(mask) == 16 and not ids.flags.owndata for ids, mask in pairs)
        assert all(mask.buffers()[1].address in pages for _, mask in pairs)
        assert sum(mask.true_count for _, mask in pairs) == one.tokens
        assert all(mask.true_count == 16 for _, mask in pairs[:-1])
    back = arrow_tokens.read_documents(manifest)
    assert back.rdd.getNumPartitions() == len(files)
    assert [r.doc_id for r in back.orderBy("start").collect()] == list(range(500))
