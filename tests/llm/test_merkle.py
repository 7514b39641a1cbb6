"""The Merkle manifest against a tree built in plain Python, and its SQL."""

import hashlib
import zlib
from collections import Counter

import duckdb
import pytest
from conftest import EDGES

from parcelwing.llm import merkle, oracles, queries

UPPER = {c: c + 32 for c in range(65, 91)}
NAMES = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    shown = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*map(row.get, merkle.FIELDS[:4]), text))
    return digest("".join(shown))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def path(tree, at):
    out = []
    for level in tree[:-1]:
        run = at // 16 * 16
        out.append(("".join(level[run:at]), "".join(level[at + 1:run + 16])))
        at //= 16
    return out


def brute(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append((row["doc_id"], leaf(row, row["text"]), row))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        by_source[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {s: levels([x[1] for x in by_source[s]]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    for number, s in enumerate(order):
        for at, (doc_id, own, row) in enumerate(by_source[s]):
            sides = path(trees[s], at) + path(top, number)
            folded = own
            if doc_id is not None and row["text"] is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
                folded = leaf(row, row["text"].translate(UPPER))
            for left, right in sides:
                folded = digest(left + folded + right)
            yield (doc_id, own, trees[s][-1][0], top[-1][0], digest("".join(a + b for a, b in sides)), folded,
                   folded == top[-1][0])


def answer(frame):
    return Counter(tuple(r[n] for n in NAMES) for r in frame.collect())


def test_query(spark, folder, rows):
    want = Counter(brute(rows("documents")))
    assert answer(queries.QUERIES["op12_merkle"](spark, folder)) == want
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    assert Counter(con.sql(f"SELECT {', '.join(NAMES)} FROM ({oracles.merkle()})").fetchall()) == want


def test_edges(edges, nothing):
    got = answer(merkle.manifest(edges))
    assert got == Counter(brute([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), (i, t, "en", s, None)))
                                 for i, t, s in EDGES]))
    assert merkle.manifest(nothing).count() == 0


@pytest.mark.parametrize("sizes", [[1], [16], [17, 1], [256, 257], [4097, 1, 40], [1] * 300])
def test_shapes(spark, sizes):
    """Lone leaves, full and just overfull levels, several tiers, many sources."""
    rows, at = [], 0
    for number, size in enumerate(sizes):
        for _ in range(size):
            at += 7
            rows.append(dict(doc_id=at, text=f"Text {at}", lang=None, source=f"é{number}" if number else None, n_chars=at))
    frame = spark.createDataFrame([tuple(r.values()) for r in rows],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    assert answer(merkle.manifest(frame.repartition(4))) == Counter(brute(rows))
