"""Packing by differencing: exact cover of the ids, little padding, and the partition itself against a plain version."""

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from conftest import EDGES
from tokenizers import Tokenizer

import brute
from parcelwing.llm import differencing as D
from parcelwing.llm import queries

NAME = "byte_bpe_50k.json"


def check(got, docs, capacity=2048):
    """Every id of docs lies in one piece; sequences are gapless and fit. Returns (sequences, tokens)."""
    library = Tokenizer.from_file(P.path(NAME))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    held = Counter(i for i, _ in docs)
    assert set(by_doc) == set(held)
    for i, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        pieces = sorted((r["start"], r["length"], r["ids_crc32"]) for r in by_doc[i] if r["doc_tokens"] == len(ids))
        at = 0
        for start, length, crc in pieces[::held[i]]:
            assert start == at and length > 0 and crc == brute.crc(ids[start:start + length])
            at += length
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence), sum(r["length"] for r in got)


def test_query(spark, folder, rows):
    got = [r.asDict() for r in queries.QUERIES["op11_differencing"](spark, folder).collect()]
    sequences, tokens = check(got, [(r["doc_id"], r["text"]) for r in rows("documents")])
    assert sequences * 2048 <= 1.02 * tokens + 2048


def test_edges(edges, nothing):
    got = [r.asDict() for r in D.pack_evenly(edges, P.path(NAME), added=True).collect()]
    check(got, [(i, t) for i, t, _ in EDGES])
    small = [r.asDict() for r in D.pack_evenly(edges, P.path(NAME), added=True, capacity=16).collect()]
    check(small, [(i, t) for i, t, _ in EDGES], 16)
    assert D.pack_evenly(nothing, P.path(NAME)).count() == 0


def plain(sizes, windows):
    """Largest differencing with lists: the window sums."""
    held = sorted(([-n, k, [n] + [0] * (windows - 1)] for k, n in enumerate(sizes)))
    number = len(held)
    while len(held) > 1:
        (_, _, a), (_, _, b) = held[:2]
        merged = sorted((x + y for x, y in zip(a, b[::-1])), reverse=True)
        spread = merged[0] - merged[-1] if windows > 1 else merged[0]
        held = sorted([*held[2:], [-spread, number, merged]])
        number += 1
    return held[0][2]


@pytest.mark.parametrize("seed", range(4))
def test_partition(seed):
    random = np.random.default_rng(seed)
    for _ in range(25):
        sizes = random.integers(1, 60, int(random.integers(1, 40)))
        windows = int(random.integers(1, 9))
        tokens, where = D.differenced(sizes, windows)
        assert tokens.tolist() == plain(sizes.tolist(), windows)
        assert np.bincount(where, sizes, windows).astype(int).tolist() == tokens.tolist()


def test_windows_rise():
    """Pieces over half the capacity cannot share a window: one each; otherwise sums are near-equal."""
    count, where = D.windowed(np.full(50, 1025))
    assert count == 50 and len(set(where.tolist())) == 50
    assert D.windowed(np.array([2048] * 30))[0] == 30
    assert D.windowed(np.array([5]))[0] == 1
    random = np.random.default_rng(5)
    sizes = np.r_[random.integers(100, 2049, 300), np.full(900, 30)]
    count, where = D.windowed(sizes)
    sums = np.bincount(where, sizes, count)
    assert sums.max() <= 2048 and sums.max() - sums.min() < 64 and count * 2048 < 1.02 * sizes.sum()
