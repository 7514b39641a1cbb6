"""Word hashes and shingle sets of many texts at once, with numpy.

Words are runs of bytes other than space and the controls 9 to 13; A-Z count as
a-z. A word's hash is a polynomial of its bytes modulo 2**64, mixed; a
shingle's hash combines its words' hashes in order.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15
_CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_values() -> np.ndarray:
    codes = np.arange(256, dtype=np.uint64)
    codes[65:91] += np.uint64(32)
    return mix(codes + np.uint64(0x1234567))


_VALUES = _byte_values()


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base % (1 << 64), dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_BASE, _CHUNK)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), _CHUNK)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words in an array of bytes."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none
    space = _SPACE[data]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edges = np.concatenate(([0], edges))
    if len(edges) % 2:
        edges = np.append(edges, len(data))
    starts, ends = edges[::2], edges[1::2]
    n = len(data)
    up = _UP[:n] if n <= _CHUNK else _powers(_BASE, n)
    down = _DOWN[starts] if n <= _CHUNK else _powers(pow(_BASE, -1, 1 << 64), n)[starts]
    running = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[data] * up, out=running[1:])
    return mix((running[ends] - running[starts]) * down), starts, ends


def words_of(texts: list[bytes]) -> list[np.ndarray]:
    """Word hashes of each text."""
    out: list[np.ndarray] = []
    start = 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(texts[stop]) < _CHUNK - 1):
            size += len(texts[stop]) + 1
            stop += 1
        part = texts[start:stop]
        hashes, starts, _ = word_hashes(np.frombuffer(b"\n".join(part) + b"\n", np.uint8))
        bounds = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in part]))
        begin = 0
        for bound in bounds:
            out.append(hashes[begin:bound])
            begin = bound
        start = stop
    return out


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words; of the whole text if it has fewer; none without words."""
    if not len(words):
        return words
    size = min(size, len(words))
    many = len(words) - size + 1
    hashes = words[:many] + np.uint64(size)
    for shift in range(1, size):
        hashes = mix(hashes * np.uint64(0x2545F4914F6CDD1D) + words[shift:many + shift])
    hashes = np.sort(hashes)
    return hashes[np.concatenate(([True], hashes[1:] != hashes[:-1]))]


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    return [shingle_set(words, size) for words in words_of(texts)]
