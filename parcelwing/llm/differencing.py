"""Packing token sequences by Karmarkar-Karp multiway differencing.

Documents become pieces: a longer one near-equal parts that fit, and one
document in eight short grains, which even out what larger pieces leave. Pieces
are dealt at random into blocks of bounded size, and a task partitions a block
into windows. Each piece starts as a partial partition of its own: it in one
window, nothing in the others. The two partitions with the largest imbalance are
merged, fullest window with emptiest, until one is left. While its fullest
window exceeds the capacity, the block is done again with more windows.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwing.llm.common import bounded, stored
from parcelwing.llm.tokens import piece_encoder

CAPACITY = 2048
WINDOWS = 128            # windows of a block, about
BLOCK_PIECES = 16_384    # pieces of a block, about
GRAIN = 32               # tokens of a grain
GRAINS_OF = 8            # one document in so many becomes grains
BLOCK_NUMBERS = 1 << 20  # sequence numbers of a block

_COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
_RESULT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cuts(tokens: int, most: int) -> np.ndarray:
    """Bounds of the fewest near-equal parts of at most so many tokens."""
    parts = -(-tokens // most)
    return np.arange(parts + 1) * tokens // parts


def _pieces(tokenizer: str, end: int, capacity: int, added: bool, batches) -> Iterator[pa.RecordBatch]:
    encoder = piece_encoder(tokenizer, added)
    last = np.array([end], "<u4").tobytes()
    for batch in bounded(batches, "text", 4 << 20):
        rows = []
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts)):
            data = memoryview(ids + last)
            n = len(data) // 4
            chosen = zlib.crc32(data, (doc_id or 0) & 0xFFFFFFFF) % GRAINS_OF == 0
            at = cuts(n, min(GRAIN, capacity) if chosen else capacity).tolist()
            rows += [(doc_id, a, b - a, zlib.crc32(data[4 * a:4 * b]), n) for a, b in zip(at, at[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in list(zip(*rows)) or [[]] * 5], names=_COLUMNS)


Partition = tuple[np.ndarray, np.ndarray, np.ndarray]   # per window, emptiest first: tokens, first piece, last piece


def _merged(one: Partition, other: Partition, following: np.ndarray) -> Partition:
    """Two partitions as one, emptiest windows with fullest."""
    tokens, first, last = one
    other_tokens, other_first, other_last = (x[::-1] for x in other)
    both = (last >= 0) & (other_first >= 0)
    following[last[both]] = other_first[both]
    tokens = tokens + other_tokens
    first, last = np.where(first >= 0, first, other_first), np.where(other_last >= 0, other_last, last)
    order = np.argsort(tokens, kind="stable")
    return tokens[order], first[order], last[order]


def _taken(one: Partition, piece: int, size: int, following: np.ndarray) -> Partition:
    """A partition with one more piece, in its emptiest window, which moves up to its new place."""
    tokens, first, last = one
    size += int(tokens[0])
    begin, end = int(first[0]), int(last[0])
    if end >= 0:
        following[end] = piece
    to = max(int(tokens.searchsorted(size)) - 1, 0)
    for column, value in ((tokens, size), (first, begin if begin >= 0 else piece), (last, piece)):
        column[:to] = column[1:to + 1]
        column[to] = value
    return one


def differenced(sizes: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each window, fullest first, and the window of each piece.

    A window's pieces form a chain, so that two windows join in one step.
    """
    following = np.full(len(sizes), -1)
    lengths = sizes.tolist()
    heap: list[tuple[int, int, int | Partition]] = [(-n, at, at) for at, n in enumerate(lengths)]
    heapq.heapify(heap)
    number = len(heap)
    while len(heap) > 1 or isinstance(heap[0][2], int):
        held = heapq.heappop(heap)[2]
        if isinstance(held, int):
            held, piece = (np.zeros(windows, np.int64), np.full(windows, -1), np.full(windows, -1)), held
            held = _taken(held, piece, lengths[piece], following)
        if heap:
            other = heap[0][2]
            held = _taken(held, other, lengths[other], following) if isinstance(other, int) else _merged(held, other, following)
            heapq.heapreplace(heap, (int(held[0][0] - held[0][-1]), number, held))
        else:
            heap.append((0, number, held))
        number += 1
    tokens, first, _ = heap[0][2]
    where = np.zeros(len(sizes), np.int64)
    for window, piece in enumerate(first[::-1].tolist()):
        while piece >= 0:
            where[piece] = window
            piece = int(following[piece])
    return tokens[::-1], where


def windowed(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[int, np.ndarray]:
    """How many windows, and the window of each piece; none exceeds the capacity.

    The count starts at the least possible one. If the fullest window exceeds
    the capacity, it rises to where the mean leaves room for that excess.
    """
    total = int(sizes.sum())
    windows = -(-total // capacity)
    while True:
        tokens, where = differenced(sizes, windows)
        if tokens[0] <= capacity:
            return windows, where
        room = capacity - (int(tokens[0]) - total / windows)
        asked = int(total / room) if room > 0 else windows
        windows = min(max(windows + 1, min(asked, windows + windows // 16)), len(sizes))


def _placed(number: int, block: pa.Table, capacity: int) -> pa.Table:
    """The pieces of one block with their sequences and places there."""
    block = block.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("row", "ascending")])
    sizes = block.column("length").to_numpy()
    _, where = windowed(sizes, capacity)
    order = np.argsort(where, kind="stable")
    before = np.cumsum(sizes[order]) - sizes[order]
    begins = np.r_[True, np.diff(where[order]) > 0]
    offset = np.empty(len(sizes), np.int64)
    offset[order] = before - np.maximum.accumulate(np.where(begins, before, 0))
    return pa.table([*(block.column(c) for c in _COLUMNS), pa.array(number * BLOCK_NUMBERS + where), pa.array(offset)],
                    names=[*_COLUMNS, "sequence_id", "offset"])


def pack_evenly(docs: DataFrame, tokenizer: str, end: int = 1, capacity: int = CAPACITY, added: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece of docs(doc_id, text).

    Each text's ids end with `end`. A null text is empty, one token. Rows repeat
    as they came, each with its own pieces, also without a doc_id; other columns
    are not looked at. Windows of a block hold nearly equal counts of tokens; a
    block of fewer tokens than one window is one window. An empty table has no
    pieces.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cut = base.mapInArrow(partial(_pieces, tokenizer, end, capacity, added),
                          "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")
    # the row number is stored with the piece: equal pieces differ in it, so copies spread over blocks
    pieces = stored(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    tokens, rows = pieces.agg(F.sum("length"), F.count(F.lit(1))).first()
    blocks = max(1, -(-(tokens or 0) // (WINDOWS * capacity)), -(-rows // BLOCK_PIECES))
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), blocks // WINDOWS)

    def place(key: tuple[pa.Scalar, ...], block: pa.Table) -> pa.Table:
        return _placed(key[0].as_py(), block, capacity)

    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))).repartition(tasks, "block")
    return dealt.groupBy("block").applyInArrow(place, _RESULT)
