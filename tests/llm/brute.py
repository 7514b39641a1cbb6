"""Plain Python versions of the contracts, one text at a time."""

import base64
import hashlib
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import public_tokenizers as P
import tiktoken
from tokenizers import Tokenizer

UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, k):
    w = words((text or "").translate(UPPER))
    if not w:
        return frozenset()
    k = min(k, len(w))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def components(docs, k, percent):
    """doc_id -> (set size, smallest linked doc_id) over (doc_id, text) with unique ids."""
    sets = {i: shingles(t, k) for i, t in docs}
    index = {}
    for i, s in sets.items():
        for x in s:
            index.setdefault(x, []).append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        shared = Counter(j for x in s for j in index[x] if j > i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


@lru_cache
def tokenizer(name):
    t = Tokenizer.from_file(P.path(name))
    t.encode_special_tokens = True
    return t


def ids(name, text, end):
    return tokenizer(name).encode(text or "", add_special_tokens=False).ids + [end]


def crc(numbers):
    return zlib.crc32(np.array(numbers, "<u4").tobytes())


@lru_cache
def ranks():
    lines = open(P.path("byte_bpe_multi_50k.tiktoken"), "rb")
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=table, special_tokens={})


def coded(text):
    numbers = ranks().encode_ordinary(text or "")
    decoded = ranks().decode_bytes(numbers)
    assert decoded == (text or "").encode()
    return (len(numbers), hashlib.sha256(np.array(numbers, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(decoded).hexdigest())


def figures(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    count = Counter(windows)
    covered = {p for i, x in enumerate(windows) if count[x] > 1 for p in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(covered), failed)


def kept(docs):
    """(doc_id, verdict) per row of (doc_id, text, source), by the method of the line rules."""
    norm = lambda x: " ".join(re.findall(r"[^ \t\n\x0b\f\r]+", x.translate(UPPER)))
    spread, hosts = {}, {}
    for _, text, source in docs:
        if text is not None:
            hosts.setdefault(source, set()).add(text)
            for line in text.split("\n"):
                if words(line):
                    spread.setdefault((source, norm(line)), set()).add(text)
    out = []
    for i, text, source in docs:
        lost = every = 0
        for line in (text or "").split("\n"):
            n = len(words(line))
            every += n
            if n:
                df = len(spread[source, norm(line)])
                lost += n * (df > 10 and 100 * df > 5 * len(hosts[source]))
        out.append((i, not figures(text)[5] and not lost * 100 > 70 * every))
    return out


LICENSES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def licenses(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
    at, labels = [], set()
    for phrase, label in LICENSES.items():
        p = phrase.split(" ")
        hits = [i for i in range(len(w)) if w[i:i + len(p)] == p]
        at += hits
        labels |= {label} if hits else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)), labels
