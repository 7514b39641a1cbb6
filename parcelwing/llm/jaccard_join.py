"""Similarity join of texts on word shingles, with trees of token bitmaps.

Two texts link when 100 * |A & B| >= percent * |A | B| over their sets of
distinct k-word shingles. Linked sets agree in a short prefix of any common
order of the tokens, so every set stands under each token of its prefix. The
sets below one token form a tree: leaves hold a bitmap of a set's tokens and its
size, inner nodes the OR of their children's bitmaps and the range of their
sizes. Two nodes are only opened against each other when the largest overlap
that their bitmaps and sizes allow reaches what a link needs.

Large groups. Texts with the same set are one vertex. The order of the tokens
puts the most frequent ones last (a list of fixed length), so a common line or
phrase is not a meeting place. Tokens that hold the same sets, as those of a
shared passage do, are one meeting place. A first round links each set to the leaders of
most of its tokens; what that has joined is one component, and the traversal passes over node
pairs inside one component. What it finds below a crowded token is taken in
rounds, of each set the nearest sets of other components first: where those
link, the rest has met by then and is never compared; where they do not, a round
without a limit takes all that is left. Of the pairs that a task compares it
passes on a spanning forest, so links follow the sets, not their pairs. A token's sets are cut into blocks by size; blocks meet only
where their size ranges allow a link, each block pair in a task of its own. No
candidate is dropped anywhere, and every candidate is verified on whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from parcelwing.llm.common import bounded, encoded, plain, stored
from parcelwing.llm.components import connected
from parcelwing.llm.shingles import mix, shingle_set, shingle_sets

FREQUENT_TOKENS = 65_536   # length of the list of tokens that the order puts last, 512 KB
BLOCK = 512                # sets of one token in a block
LEADERS = 4                # leaders that a set is compared with in the first round; later rounds take all others
NEAREST = 4                # candidates of a set below a crowded token in the first traversal
MORE = 16                  # times as many in each further one; the third is without a cut, as a set meets fewer than 2 * BLOCK
STAR = 256                 # sets that are compared with a leader at once
SMALL = 32                 # groups up to this size are compared without a tree
FANOUT = 8
_LOWEST = np.array([(1 << min(n, 8)) - 1 for n in range(16)], np.uint8)
_OPEN = np.stack((np.tile(_LOWEST, 16), np.repeat(_LOWEST, 16)), axis=1)   # both buckets of a byte as sent
_CARRIED = pa.schema([("token", pa.int64()), ("i", pa.int64()), ("j", pa.int64()), ("set_id", pa.int64()),
                      ("n", pa.int64()), ("comp", pa.int64()), ("bits", pa.binary())])


def _set_id(tokens: np.ndarray) -> int:
    return int((mix(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))).astype(np.int64))


def _digest(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Set id and size per text; the tokens that are frequent in the batch stand on its first row."""
    for batch in batches:
        sets = [s for part in bounded([batch], "text") for s in shingle_sets(encoded(part, "text"), size)]
        ids = [_set_id(s) if len(s) else None for s in sets]
        distinct = {i: s for i, s in zip(ids, sets) if i is not None}
        frequent = []
        if distinct:
            tokens, counts = np.unique(np.concatenate(list(distinct.values())), return_counts=True)
            often = counts >= max(4, len(distinct) / 1000)
            frequent = [{"token": t, "n": n} for t, n in zip(tokens[often].view(np.int64).tolist(),
                                                             counts[often].tolist())]
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id").cast(pa.int64()), pa.array(ids, pa.int64()),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([frequent if row == 0 else [] for row in range(len(sets))],
                     pa.list_(pa.struct([("token", pa.int64()), ("n", pa.int64())]))),
        ], names=["doc_id", "set_id", "n", "frequent"])


def prefix_length(n: int, percent: int) -> int:
    """Tokens of a set of n of which a link needs one: all but one less than the smallest overlap."""
    return n - (-(-percent * n // 100)) + 1


def bitmap(tokens: np.ndarray) -> bytes:
    """Bitmap of a set as it is sent: tokens by bucket, half a byte each.

    Each bucket has eight bits, one per token and set from the lowest, so their
    number tells them; tokens beyond eight have none. The buckets are the least
    power of two that leaves two tokens to each on average, so nearly all tokens
    have a bit of their own.
    """
    buckets = max(8, 1 << (-(-len(tokens) // 2) - 1).bit_length())
    at = ((tokens >> np.uint64(7)) & np.uint64(buckets - 1)).astype(np.int64)
    counts = np.minimum(np.bincount(at, minlength=buckets), 8).astype(np.uint8)
    return (counts[::2] | counts[1::2] << np.uint8(4)).tobytes()


def opened(sent: list[bytes]) -> list[bytes]:
    """The bitmaps themselves, a byte per bucket."""
    return [_OPEN[np.frombuffer(s, np.uint8)].tobytes() for s in sent]


def _prefixes(size: int, percent: int, frequent: np.ndarray, batches) -> Iterator[pa.RecordBatch]:
    """Prefix (rare tokens first) and bitmap of each text's set."""
    for batch in bounded(batches, "text", 4 << 20):
        out = []
        for doc_id, tokens in zip(batch.column("doc_id").to_pylist(), shingle_sets(encoded(batch, "text"), size)):
            if not len(tokens) or doc_id is None:
                continue
            ordered = tokens
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
                late = frequent[at] == tokens
                ordered = np.concatenate((tokens[~late], tokens[late]))
            prefix = ordered[:prefix_length(len(tokens), percent)].view(np.int64)
            out.append((doc_id, _set_id(tokens), len(tokens), prefix, bitmap(tokens)))
        columns = list(zip(*out)) or [[]] * 5
        types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                         names=["doc_id", "set_id", "n", "prefix", "bits"])


# -- bounds ------------------------------------------------------------------

def _needed(na, nb, percent: int):
    """Smallest overlap of a link."""
    return -(-percent * (na + nb) // (100 + percent))




def _prune_pairs(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        bits = [opened(batch.column(c).to_pylist()) for c in ("a_bits", "b_bits")]
        for a, b, na, nb, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "a_n", "b_n")), *bits):
            if _bound(x, na, y, nb) >= _needed(na, nb, percent):
                keep.append((a, b))
        yield _pair_batch(keep)


def _bound(a: bytes, na: int, b: bytes, nb: int) -> int:
    """Largest overlap that two bitmaps allow.

    A bucket's bits are set from the lowest, so the AND counts the smaller
    number of tokens. Tokens without a bit may all be common. The wider bitmap
    is folded to the width of the other.
    """
    a, b = _folded(a, len(b)), _folded(b, len(a))
    x, y = int.from_bytes(a, "big"), int.from_bytes(b, "big")
    return (x & y).bit_count() + min(na - x.bit_count(), nb - y.bit_count())


def _folded(bits: bytes, width: int) -> bytes:
    """The bitmap with no more than `width` buckets."""
    if len(bits) <= width:
        return bits
    counts = np.bitwise_count(np.frombuffer(bits, np.uint8)).reshape(-1, width).sum(0)
    return _LOWEST[np.minimum(counts, 8)].tobytes()


class Tree:
    """Signature tree over the sets of one token, in order of size."""

    def __init__(self, n: np.ndarray, comp: np.ndarray, bits: list[bytes]):
        width = max(map(len, bits))
        words = np.frombuffer(b"".join(s * (width // len(s)) for s in bits), np.uint64).reshape(len(bits), -1)
        own = np.array([len(s) for s in bits]) // 8
        ones = np.bitwise_count(words).sum(1, dtype=np.int64) * own // words.shape[1]
        level = {"bits": words, "low": n, "high": n, "spare": n - ones, "first": comp, "last": comp}
        self.levels = [level]
        join = {"bits": np.bitwise_or, "low": np.minimum, "high": np.maximum, "spare": np.maximum,
                "first": np.minimum, "last": np.maximum}
        while len(level["low"]) > FANOUT:
            cuts = np.arange(0, len(level["low"]), FANOUT)
            level = {name: join[name].reduceat(values, cuts, axis=0) for name, values in level.items()}
            self.levels.append(level)

    def may_link(self, depth: int, u: np.ndarray, v: np.ndarray, percent: int) -> np.ndarray:
        """Which node pairs may hold a link between two components."""
        x = self.levels[depth]
        open_ = (x["high"][u] * 100 >= percent * x["low"][v]) & (x["high"][v] * 100 >= percent * x["low"][u])
        open_ &= ~((x["first"][u] == x["last"][u]) & (x["first"][v] == x["last"][v]) & (x["first"][u] == x["first"][v]))
        at = np.flatnonzero(open_)
        step = max(1, (4 << 20) // (8 * x["bits"].shape[1]))
        for start in range(0, len(at), step):
            some = at[start:start + step]
            both = np.bitwise_count(x["bits"][u[some]] & x["bits"][v[some]]).sum(1, dtype=np.int64)
            most = both + np.minimum(x["spare"][u[some]], x["spare"][v[some]])
            open_[some] = most >= _needed(x["low"][u[some]], x["low"][v[some]], percent)
        return open_

    def candidates(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of leaves that the dual traversal could not rule out, first below second."""
        top = np.arange(len(self.levels[-1]["low"]))
        stack = [(len(self.levels) - 1, *(x.ravel() for x in np.meshgrid(top, top, indexing="ij")))]
        found = []
        while stack:
            depth, u, v = stack.pop()
            ordered = u <= v if depth else u < v
            u, v = u[ordered], v[ordered]
            open_ = self.may_link(depth, u, v, percent)
            u, v = u[open_], v[open_]
            if not depth:
                found.append((u, v))
                continue
            for start in range(0, len(u), 4096):
                uu, vv = u[start:start + 4096], v[start:start + 4096]
                child = np.arange(FANOUT)
                below_u = np.repeat(uu[:, None] * FANOUT + child, FANOUT, axis=1).ravel()
                below_v = np.tile(vv[:, None] * FANOUT + child, (1, FANOUT)).ravel()
                count = len(self.levels[depth - 1]["low"])
                inside = (below_u < count) & (below_v < count)
                stack.append((depth - 1, below_u[inside], below_v[inside]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _traverse(percent: int, nearest: int, block: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of rows sorted by (token, i, j, n); a group that the batch cuts is carried on.

    Tokens of which some candidates wait for another round come in the column `waits`.
    """
    rest = None
    for batch in batches:
        part = pa.Table.from_batches([batch.cast(_CARRIED)])
        if rest is not None and rest.num_rows:
            part = pa.concat_tables([rest, part])
        part = part.combine_chunks()
        keys = np.stack([part.column(c).to_numpy() for c in ("token", "i", "j")])
        change = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
        if not len(change):
            rest = part
            continue
        rest = part.slice(change[-1])
        yield _pairs_of(part.slice(0, change[-1]), np.concatenate(([0], change)), percent, nearest, block)
    if rest is not None and rest.num_rows:
        keys = np.stack([rest.column(c).to_numpy() for c in ("token", "i", "j")])
        change = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
        yield _pairs_of(rest, np.concatenate(([0], change, [rest.num_rows])), percent, nearest, block)


def _nearest(u: np.ndarray, v: np.ndarray, likeness: np.ndarray, most: int) -> np.ndarray:
    """Which pairs are among the `most` likeliest of one of their ends."""
    ends, others = np.concatenate((u, v)), np.concatenate((v, u))
    order = np.lexsort((others, -np.tile(likeness, 2), ends))
    place = np.empty(len(ends), np.int64)
    place[order] = np.arange(len(ends)) - np.searchsorted(ends[order], ends[order])
    return np.minimum(place[:len(u)], place[len(u):]) < most


def _pairs_of(rows: pa.Table, cuts: np.ndarray, percent: int, nearest: int, block: int) -> pa.RecordBatch:
    ids, n, comp = (rows.column(c).to_numpy() for c in ("set_id", "n", "comp"))
    bits = opened(rows.column("bits").to_pylist())
    sizes = np.diff(cuts)
    group = np.repeat(np.arange(len(sizes)), sizes)
    small = (sizes <= SMALL)[group]
    names = rows.column("token").to_numpy() * 1_000_003 + rows.column("i").to_numpy() * 1_009 + rows.column("j").to_numpy()
    pairs: dict[tuple[int, int], int] = {}     # pair -> the group that compares it
    for shift in range(1, int(min(SMALL, max(sizes, default=0)))):
        same = (group[shift:] == group[:-shift]) & small[shift:] & (comp[shift:] != comp[:-shift])
        same &= (n[:-shift] * 100 >= percent * n[shift:]) & (n[shift:] * 100 >= percent * n[:-shift])
        for at in np.flatnonzero(same).tolist():
            x, y = int(ids[at]), int(ids[at + shift])
            pair = (min(x, y), max(x, y))
            if pair not in pairs and _bound(bits[at], int(n[at]), bits[at + shift],
                                            int(n[at + shift])) >= _needed(int(n[at]), int(n[at + shift]), percent):
                pairs[pair] = int(names[at])
    waits = set()
    for number in np.flatnonzero(sizes > SMALL).tolist():
        low, high = int(cuts[number]), int(cuts[number + 1])
        tree = Tree(n[low:high], comp[low:high], bits[low:high])
        u, v = tree.candidates(percent)
        own = range(low, high)
        other = comp[low + u] != comp[low + v]
        if rows.column("i")[low].as_py() != rows.column("j")[low].as_py():    # rows of the lower block come first
            other &= (u < block) & (v >= block)
        u, v = u[other], v[other]
        most = np.array([_bound(bits[own[x]], int(n[own[x]]), bits[own[y]], int(n[own[y]]))
                         for x, y in zip(u.tolist(), v.tolist())], np.int64)
        both = n[low + u] + n[low + v]
        near = most >= _needed(n[low + u], n[low + v], percent)
        u, v, likeness = u[near], v[near], (most / both)[near]
        taken = _nearest(u, v, likeness, nearest)
        if not taken.all():
            waits.add(int(rows.column("token")[low].as_py()))
        x, y = ids[low + u[taken]], ids[low + v[taken]]
        pairs.update(dict.fromkeys(zip(np.minimum(x, y).tolist(), np.maximum(x, y).tolist()), int(names[low])))
    found = [(g, a, b, None) for (a, b), g in pairs.items() if a != b] + [(None, None, None, w) for w in sorted(waits)]
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in range(4)],
                                      names=["g", "a", "b", "waits"])


# -- verification ------------------------------------------------------------

def _compare(size: int, percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among the texts of a group; rows are sorted by group and name the partners to compare with."""
    current, sets, asked, comps = None, {}, {}, {}
    for batch in bounded(batches, "text", 4 << 20):
        out = []
        found = shingle_sets(encoded(batch, "text"), size)
        named = (batch.column(c).to_pylist() for c in ("g", "set_id", "comp", "partners"))
        for group, name, comp, partners, tokens in zip(*named, found):
            if group != current:
                out += _links(sets, asked, comps, percent)
                current, sets, asked, comps = group, {}, {}, {}
            if _set_id(tokens) == name:
                sets[name], asked[name], comps[name] = tokens, partners, comp
        yield _pair_batch(out)
    yield _pair_batch(_links(sets, asked, comps, percent))


def _links(sets: dict[int, np.ndarray], asked: dict[int, list[int]], comps: dict[int, int],
           percent: int) -> list[tuple[int, int]]:
    """Links that join the components of a group's sets; a pair that earlier links have joined is not compared."""
    out, above = [], {}

    def top(c: int) -> int:
        while c in above:
            above[c] = c = above.get(above[c], above[c])
        return c

    for a, partners in asked.items():
        for b in partners:
            if b in sets and (x := top(comps[a])) != (y := top(comps[b])):
                both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    out.append((a, b))
                    above[max(x, y)] = min(x, y)
    return out


def _pair_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, size: int, percent: int,
              joined: DataFrame | None = None) -> DataFrame:
    """Of the pairs(g, a, b) that link, by exact comparison of the whole texts, those that join components.

    A group g is what a task compares at once: its sets are few, and each text
    is sent to it once, however many pairs it stands in. joined(set_id,
    component) tells what earlier links have joined. A group returns fewer
    links than it has components; they reach whatever all its links reach.
    """
    ends = pairs.select("g", F.col("a").alias("set_id"), F.col("b").alias("partner")).union(
        pairs.select("g", "b", F.lit(None).cast("long")))
    members = stored(ends.groupBy("g", "set_id").agg(F.collect_list("partner").alias("partners")), "members")
    wanted = reps.join(members.select("set_id").distinct(), "set_id").select("set_id", "doc_id")
    if joined is None:
        named = wanted.withColumn("comp", F.col("set_id"))
    else:
        named = wanted.join(joined, "set_id", "left").select("set_id", "doc_id", _component())
    names = stored(named, "wanted")
    texts = stored(docs.join(names, "doc_id").select("set_id", "comp", "text"), "texts")
    dealt = members.join(texts, "set_id").select("g", "set_id", "comp", "partners", "text").repartition(
        "g").sortWithinPartitions("g")
    return dealt.mapInArrow(partial(_compare, size, percent), "a long, b long").distinct()


def _component() -> Column:
    """Component of a set; one that no link has joined is its own."""
    return F.coalesce("component", "set_id").alias("comp")


def _same_sets(token: WindowSpec) -> Column:
    """Key of the sets that stand under a token: their number, a sum that repeats cannot cancel, and a checksum of their ids."""
    return F.struct(F.count(F.lit(1)).over(token).alias("many"),
                    F.sum(F.shiftrightunsigned(F.xxhash64("set_id"), 32)).over(token).alias("lo"),
                    F.bit_xor(F.xxhash64(F.lit(7), "set_id")).over(token).alias("hi"))


def _one_token_per_sets(met_at: DataFrame) -> DataFrame:
    """The meetings of one token out of those that hold the same sets: the others would only repeat its tree."""
    one = met_at.groupBy("sets.many", "sets.lo", "sets.hi").agg(F.min("token").alias("token")).select("token")
    return met_at.drop("sets").join(one, "token", "left_semi")


def _likely_leaders(led: DataFrame) -> DataFrame:
    """Pairs (leader a, set b) of the first round: of each set the leaders of most of its tokens.

    In a group of near copies nearly every token has another leader; a link to
    each would be no news. Pairs that are not tried here meet in the second
    round, unless a chain of links has joined them by then.
    """
    shared = led.groupBy(F.col("lead").alias("a"), F.col("set_id").alias("b")).agg(F.count(F.lit(1)).alias("tokens"))
    place = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("tokens"), "a"))
    return shared.withColumn("place", place).filter(F.col("place") <= LEADERS).select("a", "b")


def _crossing(places: DataFrame, labels: DataFrame, sets: DataFrame, percent: int, nearest: int) -> DataFrame:
    """Candidates (g, a, b) between components below the tokens of places; rows with `waits` name a token that has more.

    In the first traversal a block meets itself and the next one only.
    """
    token = Window.partitionBy("token")
    by_size = token.orderBy("n", "set_id")
    known = places.join(labels, "set_id", "left").select("token", "set_id", "n", _component())
    mixed = known.withColumns({
        "block": F.floor((F.row_number().over(by_size) - 1) / BLOCK), "many": F.min("comp").over(token) != F.max(
            "comp").over(token), "last": F.floor((F.count(F.lit(1)).over(token) - 1) / BLOCK)}).filter("many")
    open_ = stored(mixed.drop("many"), "open")
    alone = open_.filter("last = 0").withColumns({"i": F.lit(0).cast("long"), "j": F.lit(0).cast("long")})
    large = open_.filter("last > 0")
    nodes = large.groupBy("token", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    left = nodes.select("token", F.col("block").alias("i"), F.col("high").alias("i_high"))
    right = nodes.select("token", F.col("block").alias("j"), F.col("low").alias("j_low"))
    all_meets = left.join(right, "token").filter((F.col("i") <= F.col("j")) & (
        F.col("i_high") * 100 >= percent * F.col("j_low"))).select("token", "i", "j")
    later = (F.col("j") - F.col("i") > 1) & F.lit(nearest == NEAREST)
    meets = all_meets.filter(~later)
    split = large.join(meets, "token").filter("block = i or block = j")
    columns = ["token", "i", "j", "set_id", "n", "comp"]
    bits = sets.select("set_id", "bits")
    if nearest > NEAREST:      # a later round needs few bitmaps; the others are not sent again
        bits = bits.join(stored(open_.select("set_id").distinct(), "few"), "set_id", "left_semi")
    placed = alone.select(*columns).union(split.select(*columns)).join(bits, "set_id")
    dealt = placed.select(*columns, "bits").repartition("token", "i", "j").sortWithinPartitions(
        "token", "i", "j", "n", "set_id")
    met = dealt.mapInArrow(partial(_traverse, percent, nearest, BLOCK), "g long, a long, b long, waits long")
    none = F.lit(None).cast("long")
    skipped = all_meets.filter(later).select(none.alias("g"), none.alias("a"), none.alias("b"), F.col("token").alias("waits"))
    return met.union(skipped).groupBy("a", "b", "waits").agg(F.min("g").alias("g"))


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, set_id, n_shingles, component_id.

    component_id is the smallest doc_id that links reach from the row's text. A
    text that is null or has no word has no set (set_id null, n_shingles 0) and
    is its own component. Equal texts are linked. Rows without a doc_id take the
    component of an equal text that has one, else null. A doc_id that repeats
    names several texts, each linked on its own. Other columns are not looked at.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    listed = "doc_id long, set_id long, n long, frequent array<struct<token: long, n: long>>"
    signed = stored(base.mapInArrow(partial(_digest, size), listed), "digests")
    reps = stored(signed.filter("set_id is not null and doc_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("doc_id")), "sets")
    top = signed.select(F.explode("frequent").alias("f")).groupBy("f.token").agg(F.sum("f.n").alias("n")).orderBy(
        F.desc("n"), "token").limit(FREQUENT_TOKENS)
    frequent = np.sort(np.array([r[0] for r in top.select("token").collect()], np.int64).view(np.uint64))
    with_prefix = base.mapInArrow(partial(_prefixes, size, percent, frequent),
                                  "doc_id long, set_id long, n long, prefix array<long>, bits binary")
    # rows may repeat, and texts of one doc_id may have the same set: one row per set, dealt as the join deals them
    sets = stored(with_prefix.join(reps, ["doc_id", "set_id"], "left_semi").dropDuplicates(["doc_id", "set_id"]), "prefixes")

    token = Window.partitionBy("token")
    by_size = token.orderBy("n", "set_id")
    rows = sets.select("doc_id", "set_id", "n", F.explode("prefix").alias("token")).withColumns({
        "before": F.lag("n").over(by_size), "after": F.lead("n").over(by_size)})
    near = (F.col("before") * 100 >= percent * F.col("n")) | (F.col("n") * 100 >= percent * F.col("after"))
    met_at = stored(rows.filter(near).select(
        "token", "doc_id", "set_id", "n", _same_sets(Window.partitionBy("token")).alias("sets")), "meetings")
    live = stored(_one_token_per_sets(met_at), "places")

    leader = F.min(F.struct("doc_id", "set_id")).over(token)["set_id"]
    star = _likely_leaders(live.withColumn("lead", leader).filter("lead <> set_id"))
    first, second = (sets.select(F.col("set_id").alias(s), F.col("n").alias(f"{s}_n"), F.col("bits").alias(f"{s}_bits"))
                     for s in "ab")
    alike = (F.col("a_n") * 100 >= percent * F.col("b_n")) & (F.col("b_n") * 100 >= percent * F.col("a_n"))
    starred = star.join(first, "a").join(second, "b").filter(alike).select("a", "b", "a_n", "b_n", "a_bits", "b_bits")
    tried = stored(starred.mapInArrow(partial(_prune_pairs, percent), "a long, b long"), "stars")
    many = tried.groupBy("a").agg((F.floor((F.count(F.lit(1)) - 1) / STAR) + 1).alias("parts"))
    spread = F.xxhash64("a", F.pmod(F.xxhash64("b"), F.col("parts"))).alias("g")
    stars = tried.join(many, "a").select(spread, "a", "b")
    star_links = stored(_verified(stars, base, reps, size, percent), "links")

    labels, rest, nearest = connected(star_links).withColumnRenamed("vertex", "set_id"), live, NEAREST
    while True:
        met = stored(_crossing(rest, labels, sets, percent, nearest), "crossing")
        links = stored(_verified(met.filter("waits is null").drop("waits"), base, reps, size, percent, labels), "links")
        joined = labels.select(F.col("set_id").alias("a"), F.col("component").alias("b")).union(links)
        labels = connected(joined).withColumnRenamed("vertex", "set_id")
        waiting = met.filter("waits is not null").select(F.col("waits").alias("token"))
        if waiting.isEmpty():
            break
        rest, nearest = live.join(waiting, "token", "left_semi"), nearest * MORE

    named = reps.join(labels, "set_id", "left").select("set_id", "doc_id", _component().alias("c"))
    smallest = named.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    of_set = named.join(smallest, "c").select("set_id", "component_id")
    return signed.join(of_set, "set_id", "left").select(
        "doc_id", "set_id", F.col("n").alias("n_shingles"),
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_per_group(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """docs without near-duplicates: of each component the row with the smallest doc_id stays, with its own columns.

    Rows that repeat a doc_id and its text collapse to one. Rows without a
    doc_id stay, nothing names them; so do rows without words.
    """
    linked = jaccard_components(docs, size, percent)
    kept = linked.filter("doc_id = component_id").select("doc_id").distinct()
    named = docs.filter("doc_id is not null").dropDuplicates(["doc_id", "text"]).join(kept, "doc_id", "left_semi")
    columns = [plain(c) for c in docs.columns]
    return named.select(columns).union(docs.filter("doc_id is null").select(columns))
