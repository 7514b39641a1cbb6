"""Shards that each hold the mixture of the sources, from DataFrame functions alone.

Rows of a source are put in a seeded random order; the place r of n becomes the
fraction (r + 1/2) / n. In the order of these fractions every stretch of rows
holds the sources in proportion, so shards are equal cuts of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwing.llm.common import numbered, plain, stored

BUCKET_ROWS = 100_000    # rows that one task puts in order
MIN_BUCKETS = 256


def stratified_shards(docs: DataFrame, shards: int = 24, seed: int = 17, source: str = "source",
                      key: str = "doc_id") -> DataFrame:
    """docs' key with size, text_crc32, law, shard, slot and grown_shard.

    The law is `rows`: shards hold counts at most one apart, and of each source
    a part that follows its share. size is the text's UTF-8 bytes plus 8 (null: 8).
    A null source is a source of its own; rows with a null or repeated key are
    placed like all others, ties by size and checksum. Equal texts need not
    share a shard: one group may be larger than a shard. Extra columns are left out.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col(plain(key)).alias("_id"), F.concat(
            F.when(F.col(plain(source)).isNull(), F.lit("0")).otherwise(F.lit("1")),
            F.coalesce(F.col(plain(source)).cast("string"), F.lit(""))).alias("_source"),
        (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = stored(rows.withColumn("_draw", F.xxhash64(F.lit(seed), "_id", "size", "text_crc32")), "rows")
    sizes = rows.groupBy("_source").agg(F.count(F.lit(1)).alias("_of"))
    total = rows.count()
    buckets = max(MIN_BUCKETS, -(-total // BUCKET_ROWS))
    order = ["_draw", "_id", "size", "text_crc32"]
    # the bucket must follow the order of the draw: its highest bits
    drawn = rows.withColumn("_bucket", F.floor((F.col("_draw").cast("double") / 2.0**64 + 0.5) * buckets).cast("long"))
    ranked = numbered(drawn, ["_source"], "_bucket", order, "_rank").drop("_bucket")
    placed = ranked.join(sizes, "_source").withColumn(
        "_part", (F.col("_rank") + 0.5) / F.col("_of")).withColumn(
        "_all", F.lit(0)).withColumn("_bucket", F.floor(F.col("_part") * buckets).cast("long"))
    line = numbered(placed, ["_all"], "_bucket", ["_part", "_source", *order], "_place")
    shard = F.expr(f"(_place * {shards}) div {max(total, 1)}")
    first = F.expr(f"(_shard * {max(total, 1)}L + {shards - 1}) div {shards}")
    return line.withColumn("_shard", shard).select(
        F.col("_id").alias(key), "size", "text_crc32", F.lit("rows").alias("law"),
        F.col("_shard").cast("int").alias("shard"), (F.col("_place") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
