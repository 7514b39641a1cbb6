"""Phrases whose words stand together more often than chance: exact counts per language, HAT-tries in the tasks.

Texts become blocks of word numbers once. Phrases are counted by HAT-tries: each
task has one a language, and the subtrees it spills are sorted runs of phrases
with counts, which meet by prefix (language and first two words) and are added up.

Nearly all phrases are rare, and their runs would be several times the texts. So
places are sifted first, by phrase length: tasks send sorted runs of 48-bit hashes
with counts, packed to a few bytes each, which meet by prefix and are added up. A
hash that stays below the least count belongs to rare phrases only; a frequent
phrase has only frequent parts, so the next length skips places whose shorter
parts are not. Bit tables of bounded size carry this to the tasks: they may let a
rare phrase pass, never lose a frequent one, and a corpus too large for them
costs more counting, not results. What the tries count is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelwing.llm.common import bounded, encoded, stored
from parcelwing.llm.hat_trie import HatTrie

PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLOCK_BYTES = 4 << 20
TRIE_KEYS = 1_000_000
TASK_WORDS = 1_000_000
GATE_BITS = 1 << 26          # of a bit table: at most 8 MB a phrase length
HASH_BITS = 48
SIFTED = 4_000_000           # hashes that a task holds before it sends them
MERGED = 2_000_000           # words whose hashes one prefix partition adds up, about
RUN_ROWS = 50_000

_NORMAL = bytes(10 if b in PIECE_ENDS else 32 if b == 9 else b for b in range(256))
_MIX, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _parts(data: bytes, most: int = BLOCK_BYTES) -> Iterator[bytes]:
    """Cut at ends of pieces, so that a part holds about `most` bytes; one long piece stays whole."""
    start = 0
    while len(data) - start > most:
        cut = data.rfind(b"\n", start, start + most)
        if cut <= start:
            cut = data.find(b"\n", start + most)
            if cut < 0:
                break
        yield data[start:cut]
        start = cut + 1
    yield data[start:]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of one language as word numbers (from 1, 0 ends a piece) and the words, each ended by a line feed."""
    for batch in bounded(batches, "text", BLOCK_BYTES):
        texts: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), encoded(batch, "text")):
            texts.setdefault(lang, []).append(text)
        for lang, held in texts.items():
            for data in _parts(b"\n".join(held).lower().translate(_NORMAL)):
                tokens = data.replace(b"\n", b" \n ").split(b" ")
                words = sorted(set(tokens) - {b"", b"\n"})
                number = {word: at for at, word in enumerate(words, 1)} | {b"\n": 0, b"": -1}
                ids = np.fromiter(map(number.__getitem__, tokens), np.int32, len(tokens))
                ids = ids[ids >= 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([b"\n".join(words)], pa.binary()), pa.array([ids.tobytes()], pa.binary()),
                     pa.array([int((ids > 0).sum())], pa.int64())], names=["lang", "words", "ids", "n"])


def _hashes(lang: str, words: list[bytes], ids: np.ndarray, size: int) -> np.ndarray:
    """48-bit hash of the `size` words from each place on; only the language and the words decide it."""
    seed = xxhash.xxh3_64_intdigest(lang.encode())
    table = np.array([0, *(xxhash.xxh3_64_intdigest(word, seed) for word in words)], np.uint64)
    own, places = table[ids], len(ids) - size + 1
    out = np.zeros(max(places, 0), np.uint64)
    for at in range(size if places > 0 else 0):
        out = (out ^ own[at:at + places]) * _MIX
        out ^= out >> np.uint64(29)
    return out >> np.uint64(64 - HASH_BITS)


def _bits(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash in a table of so many bits, a power of two."""
    return tuple(hashes * factor >> np.uint64(38) & np.uint64(bits - 1) for factor in (_MIX, _SPREAD))


def _packed(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """A sorted run: differences of hashes, and counts, byte plane by byte plane."""
    steps = np.diff(hashes, prepend=np.uint64(0))
    planes = np.concatenate([x.astype("<u8").view(np.uint8).reshape(-1, 8).T.ravel() for x in (steps, counts)])
    return zstandard.compress(planes.tobytes(), 3)


def _opened(run: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(run), np.uint8).reshape(2, 8, -1)
    steps, counts = (np.ascontiguousarray(x.T).view("<u8").ravel() for x in planes)
    return np.cumsum(steps), counts


def _sifted_runs(size: int, hashes: list[np.ndarray], parts: int) -> pa.RecordBatch:
    """Different hashes with their counts, in order, a run for each prefix partition."""
    found, counts = np.unique(np.concatenate(hashes), return_counts=True)
    part = (found >> np.uint64(HASH_BITS - 24)) * np.uint64(parts) >> np.uint64(24)
    names = np.unique(part)
    at = [*np.searchsorted(part, names), len(part)]
    runs = [_packed(found[a:b], counts[a:b]) for a, b in zip(at, at[1:])]
    return pa.RecordBatch.from_arrays(
        [pa.array(names.astype(np.int64)), pa.array([size] * len(runs), pa.int32()), pa.array(runs, pa.binary())],
        names=["part", "size", "run"])


def _sift(sizes: tuple[int, ...], parts: int, gates: dict, batches) -> Iterator[pa.RecordBatch]:
    """Runs of the hashes of phrases whose parts one word shorter may be frequent (as far as these were sifted)."""
    held: dict[int, list[np.ndarray]] = {size: [] for size in sizes}
    number = 0
    for batch in batches:
        for lang, words, ids in _opened_blocks(batch):
            known, passed = _known(gates, lang, words, ids)
            for size in sizes:
                places = _places(ids, size, passed, known)
                held[size].append(_hashes(lang, words, ids, size)[places])
                number += len(places)
            if number > SIFTED:
                yield from (_sifted_runs(size, hashes, parts) for size, hashes in held.items() if hashes)
                held, number = {size: [] for size in sizes}, 0
    yield from (_sifted_runs(size, hashes, parts) for size, hashes in held.items() if hashes)


def _added(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    hashes, counts = (np.concatenate(x) for x in zip(*runs))
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.diff(hashes, prepend=hashes[:1] + np.uint64(1)))
    return hashes[first], np.add.reduceat(counts, first)


def _merge_sifted(least: int, batches) -> Iterator[pa.RecordBatch]:
    """Hashes counted `least` times or more; the runs of a partition and size come one after another."""
    current, runs, held = None, [], 0

    def told() -> pa.RecordBatch:
        hashes, counts = _added(runs)
        often = hashes[counts >= least].astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array([current[1]] * len(often), pa.int32()), pa.array(often)],
                                          names=["size", "hash"])

    for batch in batches:
        for part, size, run in zip(*(batch.column(c).to_pylist() for c in ("part", "size", "run"))):
            if (part, size) != current:
                if runs:
                    yield told()
                current, runs, held = (part, size), [], 0
            runs.append(_opened(run))
            held += len(runs[-1][0])
            if held > 2 * SIFTED:
                runs = [_added(runs)]
                held = len(runs[0][0]) // 2
    if runs:
        yield told()


def sifted(blocks: DataFrame, sizes: tuple[int, ...], least: int, parts: int, gates: dict) -> DataFrame:
    """size and hash of what may be a frequent phrase of one of these sizes."""
    runs = blocks.select("lang", "words", "ids").mapInArrow(
        partial(_sift, sizes, parts, gates), "part long, size int, run binary")
    tasks = max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), parts // 4)
    dealt = runs.repartition(tasks, "part").sortWithinPartitions("part", "size")
    return stored(dealt.mapInArrow(partial(_merge_sifted, least), "size int, hash long"), "sifted")


def _marks(bits: int, batches) -> Iterator[pa.RecordBatch]:
    """Cells and masks of hashes in a bit table."""
    for batch in batches:
        at = np.concatenate(_bits(batch.column("hash").to_numpy().astype(np.uint64), bits))
        masks = (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array(masks)],
                                         names=["cell", "mask"])


def gate(hashes: DataFrame) -> np.ndarray:
    """Bit table of hashes: 16 bits each, 8 MB at most."""
    rows = hashes.count()
    bits = min(GATE_BITS, 1 << max(16, (16 * rows - 1).bit_length() if rows else 0))
    marked = hashes.select("hash").mapInArrow(partial(_marks, bits), "cell long, mask long")
    cells = marked.groupBy("cell").agg(F.bit_or("mask").alias("mask")).toArrow()   # bits / 64 rows at most
    table = np.zeros(bits // 64, np.uint64)
    table[cells.column("cell").to_numpy()] = cells.column("mask").to_numpy().view(np.uint64)
    return table


def _opened_blocks(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    for lang, data, raw in zip(*(batch.column(c).to_pylist() for c in ("lang", "words", "ids"))):
        yield lang, data.split(b"\n") if data else [], np.frombuffer(raw, np.int32)


def _passed(cells: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether a bit table holds each hash."""
    a, b = _bits(hashes, len(cells) * 64)
    held = cells[a >> np.uint64(6)] >> (a & np.uint64(63)) & cells[b >> np.uint64(6)] >> (b & np.uint64(63))
    return (held & np.uint64(1)).astype(bool)


def _known(gates: dict, lang: str, words: list[bytes], ids: np.ndarray) -> tuple[int, np.ndarray | None]:
    """The longest sifted size, and whether the phrase of that size at each place may be frequent."""
    if not gates:
        return 0, None
    size = max(gates)
    return size, _passed(gates[size].value, _hashes(lang, words, ids, size))


def _places(ids: np.ndarray, size: int, passed: np.ndarray | None, known: int) -> np.ndarray:
    """Places of phrases of `size` words inside a piece, all of whose parts of `known` words passed."""
    room = len(ids) - size + 1
    if room <= 0:
        return np.zeros(0, np.int64)
    ok = np.ones(room, bool)
    for at in range(size):
        ok &= ids[at:at + room] > 0
    if passed is not None:
        for at in range(size - known + 1):
            ok &= passed[at:at + room]
    return np.flatnonzero(ok)


def _distinct(numbers: np.ndarray, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Different phrases of a block, in key order, as (one place of each, count)."""
    most = np.uint64(int(numbers.max()) + 1)
    code = numbers[places].astype(np.uint64)
    for at in range(1, size):
        if at > 1:
            code = np.unique(code, return_inverse=True)[1].astype(np.uint64)
        code = code * most + numbers[places + at].astype(np.uint64)
    _, first, count = np.unique(code, return_index=True, return_counts=True)
    return places[first], count


def _runs(trie: HatTrie, lang: str, names: list[bytes], everything: bool) -> Iterator[pa.RecordBatch]:
    """Sorted runs that leave the trie, as rows."""
    for run in trie.spill(everything):
        for start in range(0, len(run), RUN_ROWS):
            part = run[start:start + RUN_ROWS]
            ids = np.frombuffer(b"".join([key for key, _ in part]), ">u4").tolist()
            phrases, at = [], 0
            for key, _ in part:
                upto = at + len(key) // 4
                phrases.append(b" ".join([names[i] for i in ids[at:upto]]))
                at = upto
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(part)), pa.array(phrases, pa.binary()).cast(pa.string()),
                 pa.array([len(key) // 4 for key, _ in part], pa.int32()), pa.array([n for _, n in part], pa.int64())],
                names=["lang", "phrase", "size", "n"])


def _count(sizes: tuple[int, ...], gates: dict, batches) -> Iterator[pa.RecordBatch]:
    """Phrases of these sizes in a task's blocks, from one trie a language; sizes with a gate only where it lets them pass."""
    tries: dict[str, HatTrie] = {}
    numbers: dict[bytes, int] = {}
    for batch in batches:
        for lang, words, ids in _opened_blocks(batch):
            trie = tries.setdefault(lang, HatTrie(TRIE_KEYS))
            for size in sizes:
                passed = _passed(gates[size].value, _hashes(lang, words, ids, size)) if size in gates else None
                places = _places(ids, size, passed, size)
                if not len(places):
                    continue
                here = np.unique(np.concatenate([ids[places + at] for at in range(size)]))
                own = np.zeros(len(words) + 1, np.uint32)
                own[here] = [numbers.setdefault(words[i - 1], len(numbers)) for i in here.tolist()]
                mine = own[ids]
                places, count = _distinct(mine, places, size)
                keys = np.stack([mine[places + at] for at in range(size)], axis=1).astype(">u4").tobytes()
                step = 4 * size
                trie.add(zip([keys[at:at + step] for at in range(0, len(keys), step)], count.tolist()))
            if len(numbers) > TASK_WORDS or sum(t.keys for t in tries.values()) > TRIE_KEYS:
                names = list(numbers)
                for one, held in tries.items():
                    yield from _runs(held, one, names, len(numbers) > TASK_WORDS or held is not trie)
                if len(numbers) > TASK_WORDS:
                    numbers = {}
    names = list(numbers)
    for lang, trie in tries.items():
        yield from _runs(trie, lang, names, True)


def counted(blocks: DataFrame, sizes: tuple[int, ...], least: int, gates: dict) -> DataFrame:
    """lang, phrase, size and n of all phrases of these sizes found `least` times or more.

    Runs of all tasks meet by language and first two words, so a common first
    word is no hot key.
    """
    runs = blocks.select("lang", "words", "ids").mapInArrow(
        partial(_count, sizes, gates), "lang string, phrase string, size int, n long")
    prefix = F.xxhash64("lang", F.substring_index("phrase", " ", 2))
    merged = runs.withColumn("prefix", prefix).repartition("prefix").groupBy("prefix", "lang", "phrase", "size").agg(
        F.sum("n").alias("n"))
    return stored(merged.filter(F.col("n") >= least).drop("prefix"), "phrases")


def phrase_counts(docs: DataFrame, longest: int, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, n words) and the frequent phrases of 1 to `longest` words of docs(text, lang)."""
    texts = docs.select("text", F.coalesce(F.col("lang"), F.lit("und")).alias("lang"))
    blocks = stored(texts.mapInArrow(_blocks, "lang string, words binary, ids binary, n long"), "blocks")
    totals = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    context, gates = docs.sparkSession.sparkContext, {}
    if least > 1:
        parts = 1 + (blocks.agg(F.sum("n")).first()[0] or 0) // MERGED
        # the last two sizes in one pass: few places are left by then
        for sizes in [(size,) for size in range(1, min(longest, 3) + 1)] + [tuple(range(4, longest + 1))]:
            if sizes:
                found = sifted(blocks, sizes, least, parts, gates)
                gates = gates | {size: context.broadcast(gate(found.filter(F.col("size") == size))) for size in sizes}
    return totals, counted(blocks, tuple(range(1, longest + 1)), least, gates)


def _score(a, n, left, right) -> str:
    """floor(1000 a n / (l r)) by 38 decimal digits."""
    wide = "CAST({} AS DECIMAL(38, 0))"
    return f"(1000 * {wide.format(a)} * {wide.format(n)}) div ({wide.format(left)} * {wide.format(right)})"


def collocations(docs: DataFrame, longest: int = 5, least: int = 100, top: int = 2000, percent: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the `top` phrases of each language.

    Words are lower-cased (A-Z), without blanks, inside pieces between .,;:!? and
    line ends. A phrase of 2 to `longest` words found `least` times or more is a
    candidate; its score is that of its weakest cut, 1000 a n / (l r) rounded
    down, ties to the shorter first part. A candidate goes if a longer candidate
    around it has `percent` of its count. A null text is empty, a null language
    `und`, both also where all are; repeated rows count as often as they stand
    there. Other columns are not looked at. Figures are exact below 10**38.
    """
    totals, found = phrase_counts(docs, longest, least)
    candidates = found.filter("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"),
                                                 F.split("phrase", " ", -1).alias("words"))
    at = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = candidates.select("lang", "phrase", "a", "words", "size", at).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("size")), " ").alias("last"))
    first = found.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    last = found.select("lang", F.col("phrase").alias("last"), F.col("n").alias("r"))
    scored = cuts.join(first, ["lang", "first"]).join(last, ["lang", "last"]).join(totals, "lang").withColumn(
        "score", F.expr(_score("a", "n", "l", "r")))
    weakest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = candidates.filter("size > 2").select(
        "lang", "a", "words", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("k")).select(
        "lang", "a", "words", "k", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("k") + 1)).alias("at")).select(
        "lang", F.array_join(F.slice("words", F.col("at"), F.col("k")), " ").alias("phrase"), "a")
    around = inner.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    alone = weakest.join(around, ["lang", "phrase"], "left").filter(
        F.col("around").isNull() | (100 * F.col("around") < percent * F.col("a")))
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    return alone.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
