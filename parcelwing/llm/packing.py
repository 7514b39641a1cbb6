"""Packing token sequences: a configuration linear program over the histogram of lengths.

A configuration says how many pieces of which lengths share a sequence. The
program asks for the fewest configurations that cover the histogram. Each length
has a price, more for lengths that lie behind; a knapsack dynamic program finds
the most valuable ways to fill the room beside each length, which are used whole
times for a share of what is left, and prices are renewed, until every piece is
covered. Configurations that leave much room are dissolved and their pieces
placed best fit, longest first, where that takes fewer sequences. All this sees
the histogram alone, 2048 numbers; rows meet the plan by their running number
within their length.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwing.llm.common import bounded, numbered, stored
from parcelwing.llm.tokens import piece_encoder

CAPACITY = 2048
ROUNDS = 40           # pricing problems until all that a configuration can take is taken; more follow while pieces are left
RATE = 0.02           # how much dearer lengths are that lie behind
LONGER = 1.0          # how much dearer a token is in a piece of the whole capacity
SLACK = 20            # room left from which a configuration is tried again by best fit
BUCKET_ROWS = 100_000

Config = tuple[tuple[int, int], ...]   # (length, copies), longest first


def priciest(prices: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Value of each room's most valuable multiset of lengths, and the length that it takes first, 0 for none.

    `prices` is indexed by length, from 0 to the capacity; lengths without a
    price have -inf. An unbounded knapsack by dynamic programming.
    """
    capacity = len(prices) - 1
    backward = np.zeros(capacity + 1)      # backward[capacity - room] is the value of room
    pick = np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        values = backward[capacity - room + 1:] + prices[1:room + 1]
        at = int(values.argmax())
        before = backward[capacity - room + 1]
        if values[at] > before:
            backward[capacity - room], pick[room] = values[at], at + 1
        else:
            backward[capacity - room] = before
    return backward[::-1], pick


def _filled(length: int, pick: list[int], left: list[int]) -> dict[int, int]:
    """A piece of `length` and the most valuable others in the room it leaves; none if one of them ran out since the pricing.

    A length that the room takes more often than there are pieces makes way for what fits in less room.
    """
    out, room = {length: 1}, len(pick) - 1 - length
    while room > 0:
        one = pick[room]
        if one and not left[one]:
            return {}
        if one and out.get(one, 0) < left[one]:
            out[one] = out.get(one, 0) + 1
            room -= one
        else:
            room -= 1
    return out


def cover(histogram: dict[int, int], capacity: int, rounds: int = ROUNDS) -> dict[Config, int]:
    """Configurations with how often each is used; every piece of the histogram lies in exactly one use.

    A round prices the lengths, solves the knapsack once and completes each
    length, the longest first, by the most valuable others. Of what a
    configuration could still take, a round uses a share that grows from
    1 / rounds to all of it, so `rounds` sets how often prices are renewed, not
    how much is placed: it goes on until nothing is left. From then on each
    round uses up a length at least, so there are at most `capacity` more.
    """
    left = [0] * (capacity + 1)
    for length, count in histogram.items():
        left[length] = count
    lengths = np.array(sorted(histogram))
    counts = np.array([histogram[n] for n in lengths], float)
    use: dict[Config, int] = {}
    number = 0
    while any(left):
        there = np.array([left[n] for n in lengths], float)
        behind = there / counts
        # long pieces are worth a little more than their length: what is left of a room is for short ones
        worth = lengths / capacity * (1 + LONGER * lengths / capacity)
        prices = np.full(capacity + 1, -np.inf)
        prices[lengths] = np.where(there > 0, worth * np.exp(RATE * (behind - there.sum() / counts.sum())), -np.inf)
        pick = priciest(prices)[1].tolist()
        for length in lengths[there > 0][::-1].tolist():
            if not left[length]:
                continue
            config = _filled(length, pick, left)
            if not config:
                continue
            most = min(left[n] // c for n, c in config.items())
            times = -(-most // max(1, rounds - number))
            for n, c in config.items():
                left[n] -= c * times
            key = tuple(sorted(config.items(), reverse=True))
            use[key] = use.get(key, 0) + times
        number += 1
    return use


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Config, int]]:
    """Best fit, longest first, for many pieces of one length at a time."""
    rooms: list[int] = []
    open_: dict[int, list[tuple[dict[int, int], int]]] = {}

    def put(config: dict[int, int], times: int, room: int) -> None:
        if room not in open_:
            bisect.insort(rooms, room)
            open_[room] = []
        open_[room].append((config, times))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                fit = capacity // length
                if left >= fit:
                    put({length: fit}, left // fit, capacity - fit * length)
                    left %= fit
                else:
                    put({length: left}, 1, capacity - left * length)
                    left = 0
                continue
            room = rooms[at]
            config, times = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(at)
            used = min(times, left)
            if used < times:
                put(config, times - used, room)
            put(config | {length: config.get(length, 0) + 1}, used, room - length)
            left -= used
    return [(tuple(sorted(config.items(), reverse=True)), times)
            for groups in open_.values() for config, times in groups]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Config, int]]:
    """Configurations and their whole multiplicities that hold exactly the histogram's pieces."""
    left = dict(histogram)
    out: list[tuple[Config, int]] = []
    partial_ = {n: c for n, c in left.items() if n < capacity}
    if capacity in left:
        out.append((((capacity, 1),), left.pop(capacity)))
    if partial_:
        # emptiest last: their pieces are placed again, best fit, where that takes fewer sequences
        found = sorted(cover(partial_, capacity).items(), key=lambda item: -sum(n * c for n, c in item[0]))
        cut = next((k for k, (config, _) in enumerate(found) if sum(n * c for n, c in config) < capacity - SLACK), len(found))
        rest: dict[int, int] = {}
        for config, times in found[cut:]:
            for n, c in config:
                rest[n] = rest.get(n, 0) + times * c
        again = best_fit(rest, capacity)
        fewer = sum(times for _, times in again) < sum(times for _, times in found[cut:])
        out += found[:cut] + (again if fewer else found[cut:])
    return out


def slots(configs: list[tuple[Config, int]]) -> dict[int, np.ndarray]:
    """Per length, rows (first running number, copies, first sequence, offset) in order."""
    taken: dict[int, int] = {}
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for config, times in configs:
        offset = 0
        for length, copies in config:
            first = taken.get(length, 0)
            out.setdefault(length, []).append((first, copies, sequence, offset))
            taken[length] = first + copies * times
            offset += length * copies
        sequence += times
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def _pieces(tokenizer: str, end: int, capacity: int, added: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of each text's ids; of a long one the first takes what is over."""
    encoder = piece_encoder(tokenizer, added)
    last = np.array([end], "<u4").tobytes()
    for batch in bounded(batches, "text", 4 << 20):
        rows = []
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts)):
            data = memoryview(ids + last)
            n = len(data) // 4
            cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
            rows += [(doc_id, k, a, b - a, zlib.crc32(data[4 * a:4 * b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 5, kinds)],
                                         names=["doc_id", "piece", "start", "length", "ids_crc32"])


def _place(where: dict[int, np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for one in np.unique(length).tolist():
            rows = where[one]
            at = np.flatnonzero(length == one)
            first, copies, begin, base = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1].T
            turn = rank[at] - first
            sequence[at] = begin + turn // copies
            offset[at] = base + turn % copies * one
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)],
                                         names=[*names, "sequence_id", "offset"])


def pack(docs: DataFrame, tokenizer: str, end: int = 0, capacity: int = CAPACITY, added: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of docs(doc_id, text).

    Each text's ids end with `end`; only longer ones are cut. A null text is
    empty, one token. Rows repeat as they came, also without a doc_id; other
    columns are not looked at. Sequences are gapless from offset 0.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cut = stored(base.mapInArrow(partial(_pieces, tokenizer, end, capacity, added),
                                 "doc_id long, piece int, start long, length long, ids_crc32 long"), "pieces")
    histogram = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}   # at most `capacity` rows
    where = slots(plan(histogram, capacity))
    buckets = max(16, -(-sum(histogram.values()) // BUCKET_ROWS))
    salted = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    ranked = numbered(salted, ["length"], "bucket", ["doc_id", "piece", "start", "ids_crc32"], "rank")
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast("long")).mapInArrow(
        partial(_place, where),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
