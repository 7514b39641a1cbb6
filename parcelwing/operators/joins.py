"""Join operators.

Spark broadcasts a side after checking its size (statically and again at run
time) and otherwise shuffles, splitting hot partitions. The one hint here is on
the list of crowded keys, whose length is bounded.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent and the number of rows carrying each.

    Children are counted per key first, so the anti join moves one row per key
    and a hot key weighs no more than any other. A null key is an orphan too.
    """
    counted = child.groupBy(F.col(child_key).alias("_fk")).agg(F.count(F.lit(1)).alias("orphan_rows"))
    known = parent.select(F.col(parent_key).alias("_pk"))
    missing = counted.join(known, F.col("_fk") == F.col("_pk"), "left_anti")
    return missing.withColumnRenamed("_fk", child_key)


HOT_ROWS = 1_000_000


def crowded_keys(df: DataFrame, key: str, rows: str | None = None, hot_rows: int = HOT_ROWS) -> dict:
    """Keys with more than `hot_rows` rows, and how many: at most rows / hot_rows entries.

    Meant for the time a table is written; joins are then told, and count nothing.
    `rows` names a column that says how many rows one row stands for.
    """
    number = F.count(F.lit(1)) if rows is None else F.sum(rows)
    sizes = df.filter(F.col(key).isNotNull()).groupBy(key).agg(number.alias("_rows"))
    return {r[0]: r[1] for r in sizes.filter(F.col("_rows") > hot_rows).collect()}


def left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: list[str],
    measured: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    crowded: Mapping | None = None,
) -> DataFrame:
    """Left outer join whose right side may hold very many rows of one key.

    Spark splits a hot partition of the left side by itself, but an outer join
    cannot split the right one. So the right rows of a crowded key are salted by
    `spread_by`, columns that tell them apart, and the left rows of that key are
    repeated per salt. Such a key has a match for certain, so its unmatched
    repeats are dropped and nothing else is.

    `crowded` tells such keys and their rows, as `crowded_keys` found them when
    the right side was written; without an entry the join is a plain one. If it
    is not given, keys with more than `hot_rows` rows are counted as part of the
    plan, in `measured`, a table with as many rows of a key as the right side.
    Either list has at most rows / hot_rows entries (a trillion rows: a million
    keys), so its broadcast is bounded. Wrong or old lists cost speed, not rows.
    """
    if crowded is not None and not crowded:
        return left.join(right, key, "left")
    if crowded is None:
        counted = right if measured is None else measured
        sizes = counted.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
        sizes = sizes.filter(F.col("_rows") > hot_rows)
    else:
        kind = right.schema[key].dataType.simpleString()
        told = right.sparkSession.createDataFrame(list(crowded.items()), f"{key} {kind}, _rows long")
        sizes = told.join(right.select(key), key, "left_semi")    # a key that has gone since has no match
    parts = F.ceil(F.col("_rows") / float(hot_rows)).cast("int").alias("_parts")
    hot = F.broadcast(sizes.select(key, parts))
    salt = F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("_parts")).cast("int"), F.lit(0))
    spread = right.join(hot, key, "left").withColumns({"_salt": salt, "_matched": F.lit(True)}).drop("_parts")
    salts = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    repeated = left.join(hot, key, "left").withColumn("_salt", F.explode(salts))
    joined = repeated.join(spread, [key, "_salt"], "left")
    whole = joined.filter(F.col("_parts").isNull() | F.col("_matched").isNotNull())
    return whole.drop("_salt", "_parts", "_matched")
