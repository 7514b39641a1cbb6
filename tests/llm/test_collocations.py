"""Collocations against plain Python, against SQL, and the trie by itself."""

import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import EDGES

from parcelwing.llm import collocations as K
from parcelwing.llm import hat_trie, oracles, queries

UPPER = {c: c + 32 for c in range(65, 91)}


def phrases(docs, longest):
    """Counts by (lang, words) and word totals of (lang, text)."""
    count, total = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        total[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            total[lang] += len(words)
            count.update((lang, words[i:i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    return count, total


def brute(docs, longest=5, least=100, top=2000):
    count, total = phrases(docs, longest)
    rows = {}
    for (lang, words), a in count.items():
        if len(words) < 2 or a < least:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = count[lang, words[:k]], count[lang, words[k:]]
            cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
        rows[lang, words] = (a, *min(cuts))
    inside = Counter()
    for (lang, words), (a, *_) in rows.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                inside[lang, words[i:i + k]] = max(inside[lang, words[i:i + k]], a)
    kept = {}
    for (lang, words), (a, score, _, left, right) in rows.items():
        if inside[lang, words] < a:
            kept.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted((lang, rank, phrase.decode(), -a, left, right, total[lang], -score)
                  for lang, found in kept.items()
                  for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1))


def answer(frame):
    return sorted(map(tuple, frame.collect()))


def test_query(spark, folder, rows):
    docs = [(r["lang"], r["text"]) for r in rows("documents")]
    assert answer(queries.QUERIES["op13_collocations"](spark, folder)) == brute(docs)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    for least, top in ((3, 50), (100, 2000)):
        want = sorted(con.sql(oracles.collocations(least=least, top=top)).fetchall())
        assert want == brute(docs, least=least, top=top)
        assert answer(K.collocations(spark.read.parquet(f"{folder}/documents.parquet"), least=least, top=top)) == want


def test_edges(spark, edges, nothing):
    assert answer(K.collocations(edges, least=2)) == brute([("en", t) for _, t, _ in EDGES], least=2)
    assert K.collocations(nothing).count() == 0
    texts = [(None, "A a a a a a a"), ("und", "a, b a\x0bb a\tb  a;b\r a b"), ("x", None), (None, "a\xa0b a\xa0b"), ("x", "")]
    texts += [("en", "new york is new york city\x00 new york")] * 3 + [("en", "n" * 70_000 + " new york.new york")]
    frame = spark.createDataFrame([(i, *x, 7, "n") for i, x in enumerate(texts * 2)],
                                  "doc_id long, lang string, text string, n int, phrase string")
    for least in (1, 2, 4):
        assert answer(K.collocations(frame.repartition(3), least=least, top=9)) == brute(texts * 2, least=least, top=9)


def test_large_products(spark):
    """1000 a n passes 64 bits: the figures are decimals."""
    frame = spark.createDataFrame([(3 * 10**12, 7 * 10**13, 3 * 10**12 + 1, 3 * 10**12 + 7)], "a long, n long, l long, r long")
    a, n, left, right = frame.first()
    assert frame.selectExpr(K._score("a", "n", "l", "r")).first()[0] == 1000 * a * n // (left * right)


@pytest.mark.parametrize("seed", range(3))
def test_trie(monkeypatch, seed):
    """Bursts and spills keep every count; runs are in key order."""
    monkeypatch.setattr(hat_trie, "BURST", 8)
    monkeypatch.setattr(hat_trie, "CROWD", 2)
    random = np.random.default_rng(seed)
    trie, want, got, runs = hat_trie.HatTrie(200), Counter(), Counter(), 0
    for _ in range(60):
        keys = [bytes(4 * int(random.integers(1, 6))) for _ in range(30)]
        keys = sorted(np.minimum(random.zipf(1.5, len(k) // 4), 40).astype(">u4").tobytes() for k in keys)
        counted = [(key, int(random.integers(1, 9))) for key in keys]
        trie.add(counted)
        for key, n in counted:
            want[key] += n
        assert trie.keys == trie.root.size()
        for run in trie.spill():
            assert run == sorted(run)
            runs += 1
            got.update(dict(run))
    assert trie.keys <= 260 and runs > 2
    for run in trie.spill(True):
        got.update(dict(run))
    assert got == want and trie.keys == 0


def test_task_spills(monkeypatch, rows):
    """A task with little room tells the same counts in more runs."""
    docs = [(r["lang"], r["text"]) for r in rows("documents")][:40]
    batch = pa.RecordBatch.from_arrays([pa.array([d[0] for d in docs]), pa.array([d[1] for d in docs])], names=["lang", "text"])
    monkeypatch.setattr(K, "BLOCK_BYTES", 5_000)
    blocks = list(K._blocks(iter([batch])))
    monkeypatch.setattr(K, "TRIE_KEYS", 500)
    monkeypatch.setattr(K, "TASK_WORDS", 700)
    got, rows_out = Counter(), 0
    for run in K._count((1, 2, 3, 4, 5), {}, iter(blocks)):
        for r in run.to_pylist():
            got[r["lang"], tuple(r["phrase"].split(" "))] += r["n"]
            rows_out += 1
    assert got == phrases(docs, 5)[0] and rows_out > len(got)
    # hashes of a task with little room: the same sums from more runs
    monkeypatch.setattr(K, "SIFTED", 900)
    runs = sorted((r for size in (1, 3) for b in K._sift((size,), 7, {}, iter(blocks)) for r in b.to_pylist()),
                  key=lambda r: (r["part"], r["size"]))
    often = list(K._merge_sifted(3, iter([pa.RecordBatch.from_pylist(runs)])))
    for size in (1, 3):
        want = set()
        for lang, words in (k for k, n in phrases(docs, 3)[0].items() if n >= 3 and len(k[1]) == size):
            held = [w.encode() for w in words]
            distinct = sorted(set(held))
            want.add(int(K._hashes(lang, distinct, np.array([distinct.index(w) + 1 for w in held]), size)[0]))
        assert {r["hash"] for b in often for r in b.to_pylist() if r["size"] == size} == want


def test_packed_runs():
    random = np.random.default_rng(1)
    for n in (1, 2, 1000):
        hashes = np.unique(random.integers(0, 1 << K.HASH_BITS, n, dtype=np.uint64))
        counts = random.integers(1, 1 << 40, len(hashes)).astype(np.uint64)
        got = K._opened(K._packed(hashes, counts))
        assert (got[0] == hashes).all() and (got[1] == counts).all()


def test_gate_never_loses(spark):
    ids, words = np.arange(1, 301), [f"w{i}".encode() for i in range(300)]
    hashes = K._hashes("en", words, ids, 2)
    assert len(set(hashes.tolist())) == 299 and hashes.max() < 1 << K.HASH_BITS
    table = K.gate(spark.createDataFrame([(int(h),) for h in hashes], "hash long"))
    assert K._passed(table, hashes).all() and K._passed(table, K._hashes("de", words, ids, 2)).mean() < 0.1
