"""Merkle manifest of a table: a digest per row, a root per source, one root, and a proof for every row.

Rows of a source are ranked by id. The last two base-16 digits of the rank
address a row in its block of 256: rows are grouped by all digits but the last,
then by all but the last two, and what is grouped away stays inside as an array
of structs, so one nested row holds a block with every digest in it. The blocks'
digests are rows of the next tier, by the next two digits, and so on up to one
node. Proofs come down the same way: siblings are slices of the nested arrays,
an explode gives them to the children. Inside a block nothing is joined; from
one tier to the next a row a block is.

Built from DataFrame functions alone. Digests are lowercase hex.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from parcelwing.llm.common import plain, stored
from parcelwing.llm.line_rules import LOWER, UPPER

FANOUT = 16
BLOCK = FANOUT * FANOUT     # nodes of one nested row
RANGE_ROWS = 100_000        # rows that one task puts in order
MIN_RANGES = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_OF = 5

_PATH = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _field(value: Column) -> Column:
    shown = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown))


def leaves(docs: DataFrame) -> DataFrame:
    """_key, doc_id, _hash, _changed (digest with the tampered text, null if not tampered) and _row of each row."""
    parts = {c: F.col(plain(c)) for c in FIELDS}
    changed = parts | {"text": F.translate(parts["text"], UPPER, LOWER)}
    chosen = F.crc32(parts["doc_id"].cast("string").cast("binary")) % TAMPERED_OF == 0
    key = F.concat(F.when(parts["source"].isNull(), F.lit("0")).otherwise(F.lit("1")),
                   F.coalesce(parts["source"].cast("string"), F.lit("")))
    return docs.select(
        key.alias("_key"), parts["doc_id"].cast("long").alias("doc_id"),
        digest(*map(_field, parts.values())).alias("_hash"),
        F.when(chosen, digest(*map(_field, changed.values()))).alias("_changed"),
        F.monotonically_increasing_id().alias("_row"))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with _rank within _key by `order`, and _of, the rows of that key.

    Rows are dealt by ranges of (_key, order) and numbered inside a range; a
    range's first number is the count of the ranges before it. The ranges are
    stored, so that a task done again finds the same ones.
    """
    ranges = max(MIN_RANGES, -(-rows.count() // RANGE_ROWS))
    dealt = stored(rows.repartitionByRange(ranges, "_key", *order).withColumn("_range", F.spark_partition_id()), "ranges")
    inside = dealt.withColumn("_n", F.row_number().over(Window.partitionBy("_key", "_range").orderBy(*order)) - 1)
    counts = dealt.groupBy("_key", "_range").agg(F.count(F.lit(1)).alias("_rows"))
    of_key = Window.partitionBy("_key")
    before = of_key.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumns({"_before": F.coalesce(F.sum("_rows").over(before), F.lit(0)),
                                 "_of": F.sum("_rows").over(of_key)}).drop("_rows")
    return inside.join(starts, ["_key", "_range"]).withColumn("_rank", F.col("_before") + F.col("_n")).drop(
        "_n", "_before", "_range")


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda node: node["_hash"]), "")


def _rolled(rows: DataFrame, keys: list[str], digit: str, held: list[str], name: str, more: Column) -> DataFrame:
    """Group one digit away: its nodes become the array `name`, and their digest the node's _hash."""
    nodes = F.sort_array(F.collect_list(F.struct(F.col(digit).alias("at"), "_hash", *held)))
    rolled = rows.groupBy(*keys).agg(nodes.alias(name))
    return rolled.withColumn("_hash", F.when(more, digest(_joined(F.col(name)))).otherwise(F.col(name)[0]["_hash"]))


def blocks(rows: DataFrame, held: list[str]) -> DataFrame:
    """One row per _key and block of 256 ranks: _rank and _of of the next tier, _hash and the nested _nodes.

    Both groupings keep the partitioning by key and block, so rows move once.
    A level that has a single node already is passed on without a digest.
    """
    placed = rows.select(
        "_key", "_of", "_hash", *held, F.expr(f"_rank div {BLOCK}").alias("_block"),
        (F.expr(f"_rank div {FANOUT}") % FANOUT).cast("int").alias("_high"), (F.col("_rank") % FANOUT).cast("int").alias("_low"))
    dealt = placed.repartition("_key", "_block")
    inner = _rolled(dealt, ["_key", "_of", "_block", "_high"], "_low", held, "_below", F.col("_of") > 1)
    outer = _rolled(inner, ["_key", "_of", "_block"], "_high", ["_below"], "_nodes", F.col("_of") > FANOUT)
    return outer.select("_key", F.col("_block").alias("_rank"), F.expr(f"(_of + {BLOCK - 1}) div {BLOCK}").alias("_of"),
                        F.col("_of").alias("_width"), "_hash", "_nodes")


def tiers(rows: DataFrame, held: list[str]) -> list[DataFrame]:
    """Stored blocks of each tier, up to the one with a single block for every key."""
    out = [stored(blocks(rows, held), "blocks")]
    while (out[-1].agg(F.max("_of")).first()[0] or 0) > 1:
        out.append(stored(blocks(out[-1].select("_key", "_rank", "_of", "_hash"), []), "blocks"))
    return out


def _sides(nodes: str) -> Column:
    """Each node of an array with the digests before and after it, joined."""
    return F.transform(nodes, lambda node, at: F.struct(
        node.alias("node"), F.struct(
            _joined(F.slice(nodes, F.lit(1), at)).alias("left"),
            _joined(F.slice(nodes, at + 2, F.lit(FANOUT))).alias("right")).alias("side")))


def _step(side: str, more: Column) -> Column:
    """A path of one step, or of none where the level has a single node."""
    return F.when(more, F.array(F.col(side))).otherwise(F.array().cast(_PATH))


def unfolded(stored_tiers: list[DataFrame], above: DataFrame, held: list[str], passed: list[str]) -> DataFrame:
    """Rows of the lowest tier with _hash, `held`, and `passed` and _path from `above`, one row per key.

    _path tells, from the row up, the siblings before and after at each level.
    """
    above = above.withColumn("_rank", F.lit(0).cast("long"))
    for number, block in reversed(list(enumerate(stored_tiers))):
        kept = held if number == 0 else []
        high = block.join(above, ["_key", "_rank"]).select(
            "_key", "_rank", "_width", "_path", *passed, F.explode(_sides("_nodes")).alias("_high"))
        low = high.select("_key", "_rank", "_width", "_path", *passed, "_high", F.col("_high.node._below").alias("_below")).select(
            "_key", "_rank", "_width", "_path", *passed, F.col("_high.node.at").alias("_at"),
            F.col("_high.side").alias("_side"), F.explode(_sides("_below")).alias("_low"))
        more = F.col("_width")
        above = low.select(
            "_key", (F.col("_rank") * BLOCK + F.col("_at") * FANOUT + F.col("_low.node.at")).alias("_rank"), *passed,
            F.concat(_step("_low.side", more > 1), _step("_side", more > FANOUT), "_path").alias("_path"),
            F.col("_low.node._hash").alias("_hash"), *[F.col(f"_low.node.{c}").alias(c) for c in kept])
        if number:
            above = above.drop("_hash")
    return above


def _folded(start: Column) -> Column:
    return F.aggregate("_path", start, lambda below, step: digest(step["left"], below, step["right"]))


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row of docs.

    docs has doc_id, source, lang, n_chars and text; a null is a value of its
    own in a leaf, and a null source a source of its own, before all others. Rows
    without a doc_id come first in their source and are never tampered with;
    rows with the same doc_id stand in the order of their leaves, equal rows in
    that of the table, each with a place of its own. Columns of docs beside the
    five are not looked at. An empty table has no rows and no root.
    """
    rows = stored(leaves(docs), "leaves")
    held = ["doc_id", "_changed"]
    per_source = tiers(ranked(rows, ["doc_id", "_hash", "_row"]), held)
    subroots = per_source[-1].select(F.lit("").alias("_key"), F.col("_key").alias("_source"), "_hash")
    of_sources = tiers(ranked(stored(subroots, "subroots"), ["_source"]), ["_source"])
    root = of_sources[-1].select("_key", F.col("_hash").alias("root"), F.array().cast(_PATH).alias("_path"))
    sources = unfolded(of_sources, root, ["_source"], ["root"]).select(
        F.col("_source").alias("_key"), F.col("_hash").alias("subroot"), "root", "_path")
    proved = unfolded(per_source, sources, held, ["subroot", "root"])
    siblings = F.array_join(F.transform("_path", lambda step: F.concat(step["left"], step["right"])), "")
    told = proved.select(
        "doc_id", F.col("_hash").alias("leaf"), "subroot", "root", digest(siblings).alias("proof_sha256"),
        _folded(F.coalesce("_changed", "_hash")).alias("folded_root"))
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))
