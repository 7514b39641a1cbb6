"""The registered queries against plain Python over whole test tables."""

import zlib
from collections import Counter, defaultdict

import brute
import pytest

from parcelwing.llm import queries


def answer(spark, folder, name):
    return [r.asDict() for r in queries.QUERIES[name](spark, folder).collect()]


def test_jaccard_join(spark, folder, rows):
    want = brute.components([(r["doc_id"], r["text"]) for r in rows("documents")], 3, 90)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in answer(spark, folder, "op1_jaccard_join")}
    assert got == want


def test_arrow_tokens(spark, folder, rows):
    want, start = [], 0
    for r in sorted(rows("documents"), key=lambda r: r["doc_id"]):
        ids = brute.ids("word_bpe_49k.json", r["text"], 2)
        want.append((r["doc_id"], start, len(ids), brute.crc(ids)))
        start += len(ids)
    got = answer(spark, folder, "op2_arrow_tokens")
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got) == want


def test_line_rules(spark, folder, rows):
    docs = rows("documents")
    verdict = dict(brute.kept([(r["doc_id"], r["text"], r["source"]) for r in docs]))
    want = {r["doc_id"]: (*brute.figures(r["text"]), verdict[r["doc_id"]]) for r in docs}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert {r["doc_id"]: tuple(r[n] for n in names) for r in answer(spark, folder, "op3_line_rules")} == want


def test_license_scan(spark, folder, rows):
    got = {r["doc_id"]: r for r in answer(spark, folder, "op4_license_scan")}
    assert len(got) == len(rows("documents"))
    for r in rows("documents"):
        *want, labels = brute.licenses(r["text"])
        g = got[r["doc_id"]]
        assert [g[n] for n in ("n_words", "n_base", "first_word", "last_word", "base_labels")] == want
        found = set(filter(None, g["labels"].split(",")))
        assert labels <= found and g["labels"] == ",".join(sorted(found)) and 0 <= g["score"] <= 1
        assert (g["score"] >= 0.6) == any(c in r["text"] for c in (
            "licensed under the GNU General Public License, version 3", "Licensed under the Apache License, Version 2.0",
            "Licensed under CC BY-NC 4.0", "Released under the MIT License"))


def test_byte_bpe(spark, folder, rows):
    want = {r["doc_id"]: brute.coded(r["text"]) for r in rows("documents")}
    got = answer(spark, folder, "op5_byte_bpe")
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got} == want


def test_quality_model(spark, folder, rows):
    got = {r["doc_id"]: r for r in answer(spark, folder, "op6_quality_model")}
    assert len(got) == len(rows("documents"))
    right = Counter()
    for r in got.values():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    for r in rows("labels"):
        if got[r["doc_id"]]["held_out"]:
            right[got[r["doc_id"]]["predicted"] == r["quality"]] += 1
    assert right[True] >= 0.93 * sum(right.values())


def test_topk(spark, folder, rows):
    import math

    vectors = {r["vec_id"]: [math.floor(1024 * x) for x in r["embedding"]] for r in rows("embeddings")}
    want = []
    for q in vectors:
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:10])]
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in answer(spark, folder, "op7_topk")]
    assert sorted(got) == sorted(want)


def test_packing(spark, folder, rows):
    got = answer(spark, folder, "op8_packing")
    check_packed(got, [(r["doc_id"], r["text"]) for r in rows("documents")])


def check_packed(got, docs, capacity=2048):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == {i for i, _ in docs}
    for i, text in docs:
        ids = brute.ids("byte_bpe_50k.json", text, 0)
        at = 0
        pieces = sorted(by_doc[i], key=lambda r: r["piece"])
        for k, r in enumerate(pieces):
            assert (r["piece"], r["start"]) == (k, at) and 0 < r["length"] <= capacity
            assert r["length"] == capacity or k == 0
            assert r["ids_crc32"] == brute.crc(ids[at:at + r["length"]])
            at += r["length"]
        assert at == len(ids)
    total = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        total += at
    return len(by_sequence), -(-total // capacity)


def test_wrappers(spark, folder, rows):
    import html
    import re

    got = {r["page_id"]: r for r in answer(spark, folder, "op9_wrappers")}
    assert len(got) == len(rows("pages"))
    for r in rows("pages"):
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body))
        want = "\n".join(filter(None, blocks))
        g = got[r["page_id"]]
        assert (g["url"], g["text"], g["n_chars"]) == (r["url"], want, len(want))


def test_sharding(spark, folder, rows):
    got = answer(spark, folder, "op10_sharding")
    docs = {r["doc_id"]: r for r in rows("documents")}
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        data = (docs[r["doc_id"]]["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 8, zlib.crc32(data), "rows", None)
    slots = defaultdict(list)
    mix = Counter()
    for r in got:
        slots[r["shard"]].append(r["slot"])
        mix[docs[r["doc_id"]]["source"], r["shard"]] += 1
    sizes = [len(slots[k]) for k in range(24)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    for source, n in Counter(r["source"] for r in docs.values()).items():
        assert all(abs(mix[source, k] - n / 24) < 2 for k in range(24))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered(name):
    import __spark_entry__ as entry

    assert name in entry.queries() and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_piece_encoder(name, rows):
    import numpy as np
    import public_tokenizers

    from parcelwing.llm.tokens import PieceEncoder

    texts = [r["text"] or "" for r in rows("documents")] + [
        "", " ", "  a", "a  b", "a \n b", "a\n b", " lead", "trail ", "don't we'll I'M", "<|endoftext|> x", "\x1c a\x85b",
        "é ́x ﬁ ſ ΣΣ", "日本 \U0001f600 ½3 4,5.", "\x00 \x00a", "A.B, c.,d"]
    encoder = PieceEncoder(public_tokenizers.path(name))
    got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
    assert got == [brute.tokenizer(name).encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts[::-1])] == got[::-1]
