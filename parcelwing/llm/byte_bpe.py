"""Byte-level BPE of whole tables: each distinct pre-token is encoded once, wherever it stands.

Pre-tokens are exploded with their positions, a block of neighbouring texts at a
time. Each block sends its distinct pre-tokens to the parts that their checksums
name, so all blocks' equal pre-tokens meet there and are encoded once; a
pre-token that fills a third of all text is sent once per block. The ids go back
to the block, in the order of its pre-tokens, and every text is put together by
position. Words, ids and positions travel as compressed columns, some tenths of
the text. Decoding looks each id up in the token-byte table, whose size is that
of the vocabulary.
"""

from __future__ import annotations

import base64
import hashlib
import pickle
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwing.llm.common import bounded

BLOCK_BYTES = 12 << 20   # text of a block
_PLACED = pa.schema([("block", pa.int64()), ("part", pa.int64()), ("data", pa.binary())])


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """Bytes of every token by id."""
    ranks = load_ranks(path)
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def _planes(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers byte plane by byte plane, compressed."""
    return zstandard.compress(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 3)


def _numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _explode(pattern: str, parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, part, data) of each block of texts.

    A part below `parts` holds the block's distinct pre-tokens that fall to it by
    their checksum, in order, so that all blocks' equal pre-tokens meet. Parts
    from `parts` on hold the block's texts: doc_ids, a flag for null, how many
    pre-tokens each has, and the number of the pre-token at every position, by
    (part, place in the part).
    """
    split = regex.compile(pattern).findall
    first = TaskContext.get().partitionId() << 32
    for number, batch in enumerate(bounded(batches, "text", BLOCK_BYTES)):
        codes: dict[str, int] = {}
        lengths, places = [], []
        for text in batch.column("text").to_pylist():
            words = split(text) if text else []
            lengths.append(len(words))
            places.append(np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int32, len(words)))
        block = first + number
        listed = [w.encode() for w in codes]
        part = np.array([zlib.crc32(w) % parts for w in listed], np.int64)
        order = sorted(range(len(listed)), key=lambda k: (part[k], listed[k]))
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        rows = []
        cuts = np.searchsorted(part[order], np.arange(parts + 1))
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            own = [listed[at] for at in order[cuts[k]:cuts[k + 1]]]
            sizes = np.array(list(map(len, own)), "<u4")
            rows.append((block, k, zstandard.compress(pickle.dumps((_planes(sizes), b"".join(own))), 3)))
        every = np.concatenate(places) if places else np.zeros(0, np.int32)
        often = np.lexsort((rank, -np.bincount(every, minlength=len(order))))     # frequent ones get small numbers
        small = np.empty(len(order), np.uint32)
        small[often] = np.arange(len(order), dtype=np.uint32)
        head = (batch.column("doc_id").to_pylist(), lengths, _planes(np.diff(rank[often], prepend=np.uint32(0))), _planes(small[every]))
        rows.append((block, parts + block % parts, pickle.dumps(head)))
        yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), _PLACED)], schema=_PLACED)


def _encode(path: str, pattern: str, parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of each row's pre-tokens instead of their bytes; rows are sorted by part, and texts pass as they are.

    A pre-token has its ids looked up in the part's table, where it is put when
    it is first seen.
    """
    bpe = encoding(path, pattern)
    table: dict[bytes, tuple[int, ...]] = {}
    current = None
    for batch in batches:
        out = []
        for part, data in zip(batch.column("part").to_pylist(), batch.column("data").to_pylist()):
            if part >= parts:
                out.append(data)
                continue
            if part != current:
                current, table = part, {}
            sizes, joined = pickle.loads(zstandard.decompress(data))
            ends = np.cumsum(_numbers(sizes)).tolist()
            ids = []
            start = 0
            for end in ends:
                word = joined[start:end]
                known = table.get(word)
                if known is None:
                    known = table[word] = tuple(bpe.encode_ordinary(word.decode()))
                ids.append(known)
                start = end
            counts = np.array(list(map(len, ids)), "<u4")
            out.append(pickle.dumps((_planes(counts), _planes(np.array([i for w in ids for i in w], "<u4")))))
        yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("part"), pa.array(out, pa.binary())],
                                         schema=_PLACED)


def _assemble(path: str, parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks from rows sorted by (block, part): ids by position, cut into texts, digested and decoded."""
    table = token_bytes(path)
    pieces: list[bytes] = []
    for batch in batches:
        for part, data in zip(batch.column("part").to_pylist(), batch.column("data").to_pylist()):
            if part < parts:
                counts, ids = map(_numbers, pickle.loads(data))
                packed, cuts = ids.tobytes(), (np.concatenate(([0], np.cumsum(counts, dtype=np.int64))) * 4).tolist()
                pieces += [packed[a:b] for a, b in zip(cuts, cuts[1:])]
            else:
                yield _texts(pieces, *pickle.loads(data), table)
                pieces = []


def _texts(pieces: list[bytes], doc_ids: list, lengths: list[int], rank: bytes, codes: bytes,
           table: list[bytes]) -> pa.RecordBatch:
    order = [pieces[k] for k in np.cumsum(_numbers(rank), dtype=np.uint32).tolist()]
    of = _numbers(codes)
    out, start = [], 0
    for length in lengths:
        packed = b"".join([order[k] for k in of[start:start + length].tolist()])
        ids = np.frombuffer(packed, "<u4")
        decoded = b"".join([table[i] for i in ids.tolist()])
        out.append((len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()))
        start += length
    counts, coded, text = list(zip(*out)) or ([], [], [])
    return pa.RecordBatch.from_arrays([
        pa.array(doc_ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(coded, pa.string()),
        pa.array(text, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def encode_and_decode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row of docs(doc_id, text).

    A null text is empty: no tokens, digests of nothing. Rows repeat as they
    came, also without a doc_id; other columns are not looked at. A task holds a
    block of texts, some megabytes or one long text, or the distinct pre-tokens
    of one part, whose number is that of the shuffle partitions or 64.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = max(64, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    kind = "block long, part long, data binary"
    placed = base.mapInArrow(partial(_explode, pattern, parts), kind)
    coded = placed.repartition("part").sortWithinPartitions("part").mapInArrow(
        partial(_encode, ranks, pattern, parts), kind)
    dealt = coded.repartition("block").sortWithinPartitions("block", "part")
    return dealt.mapInArrow(partial(_assemble, ranks, parts),
                            "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
