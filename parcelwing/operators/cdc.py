"""Change data capture: snapshot, difference, compaction, merge, soft delete.

A change table holds the row images and three metadata columns. An update is a
DELETE of the old image and an INSERT of the new one, both flagged as update.
Change rows that travel also carry the number of the source version that they
lead to: it orders them however they arrive, and makes repeats harmless.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwing.functions import columns as C
from parcelwing.operators.windows import comparable, latest_per_key

INSERT, DELETE = "INSERT", "DELETE"
ACTION, IS_UPDATE, ROW_ID = "_cdc_action", "_cdc_is_update", "_cdc_row_id"
METADATA = (ACTION, IS_UPDATE, ROW_ID)
VERSION = "_cdc_version"
# types whose values a hash tells apart as a comparison does
FLAT = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz", "string",
        "binary", "variant")


def row_id(keys: list[str]) -> Column:
    """Stable identity of a row: a digest of its key."""
    text = [F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys]
    return F.sha2(F.concat_ws("\x1f", *text), 256)


def initial_snapshot(df: DataFrame, keys: list[str]) -> DataFrame:
    """First read of a stream: every existing row as an insert."""
    return df.withColumns({ACTION: F.lit(INSERT), IS_UPDATE: F.lit(False), ROW_ID: row_id(keys)})


def _mark(df: DataFrame, columns: list[str]) -> Column:
    """What stands for an image in a comparison: 128 bits over the columns of flat types, and the others as they are.

    Nulls are told apart by a flag beside each value. Inside arrays and structs
    a hash passes over them, so columns of such types are compared themselves.
    """
    types = dict(df.dtypes)
    flat = [c for c in columns if types[c] in FLAT or types[c].startswith("decimal")]
    values = [v for form in comparable(df, flat, named=False) for v in (form, form.isNull())]
    hashes = [F.xxhash64(F.lit(seed), *values).alias(f"_{seed}") for seed in (1, 2)]
    return F.struct(*hashes, *[df[c] for c in columns if c not in flat])


def _emit(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Turn `_old` and `_new` images into change rows.

    `_was` and `_is` stand for the same images in comparisons and are null where
    an image is absent; images that nobody asks for are not read here, so they
    do not travel.
    """
    was, now = F.col("_was"), F.col("_is")
    actions = F.array_compact(F.array(F.when(was.isNotNull(), DELETE), F.when(now.isNotNull(), INSERT)))
    rows = df.filter(~was.eqNullSafe(now)).select(
        "_old", "_new", (was.isNotNull() & now.isNotNull()).alias(IS_UPDATE), F.explode(actions).alias(ACTION))
    image = F.when(F.col(ACTION) == DELETE, F.col("_old")).otherwise(F.col("_new"))
    return rows.select(*[image[c].alias(c) for c in columns], ACTION, IS_UPDATE).withColumn(ROW_ID, row_id(keys))


def changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Net changes that turn one version of a table into another; keys are unique.

    Both versions meet by key with their images and a mark of 128 bits each,
    which tells whether they differ.
    """
    columns = old.columns
    before = old.select(*keys, F.struct(*columns).alias("_old"), _mark(old, columns).alias("_was"))
    after = new.select(*keys, F.struct(*[new[c] for c in columns]).alias("_new"), _mark(new, columns).alias("_is"))
    return _emit(before.join(after, keys, "full_outer"), columns, keys)


def stamped(change_rows: DataFrame, version: int) -> DataFrame:
    """Change rows with the number of the source version that they lead to, counted from 1."""
    return change_rows.withColumn(VERSION, F.lit(version).cast("long"))


def capture(old: Mapping[str, DataFrame], new: Mapping[str, DataFrame], keys: Mapping[str, str],
            version: int) -> dict[str, DataFrame]:
    """Stamped net changes of every table of two versions of a source."""
    return {name: stamped(changes(old[name], new[name], [key]), version) for name, key in keys.items()}


def net(log: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Collapse all changes of a key to the net one.

    Only the first and the last image of a key matter. They are a minimum and
    a maximum, so a key with very many changes is combined before the shuffle,
    the order of arrival has no say, and rows that repeat change nothing.
    """
    columns = [c for c in log.columns if c not in (*METADATA, VERSION, version)]
    order = F.when(F.col(ACTION) == INSERT, 1).otherwise(0).alias("_order")
    form = F.struct(*comparable(log, columns)).alias("_form")
    step = F.struct(F.col(version), order, form)
    entry = F.struct(order, form, F.struct(*columns).alias("_image"))
    ends = log.groupBy(*keys).agg(F.min_by(entry, step).alias("_first"), F.max_by(entry, step).alias("_last"))
    gone, there = F.col("_first._order") == 0, F.col("_last._order") == 1
    images = ends.select(
        *keys, F.when(gone, F.col("_first._image")).alias("_old"), F.when(there, F.col("_last._image")).alias("_new"),
        F.when(gone, F.col("_first._form")).alias("_was"), F.when(there, F.col("_last._form")).alias("_is"))
    return _emit(images, columns, keys)


def with_load_time(change_rows: DataFrame, load_ts: dt.datetime | None = None) -> DataFrame:
    """Change rows as bronze stores them: `_cdc_*` columns and the load time."""
    loaded = C.moment(load_ts) if load_ts else F.current_timestamp().cast("timestamp_ntz")
    return change_rows.withColumn("_dbt_loaded_at", loaded)


def merge(target: DataFrame, change_rows: DataFrame, keys: list[str]) -> DataFrame:
    """Apply net changes: unchanged rows stay, inserted images replace or extend.

    Applying the same changes again gives the same table.
    """
    untouched = target.join(change_rows.select(*keys), keys, "left_anti")
    inserted = change_rows.filter(F.col(ACTION) == INSERT)
    return untouched.select(*target.columns).unionByName(inserted.select(*target.columns))


def soft_merge(target: DataFrame, change_rows: DataFrame, keys: list[str], at: dt.datetime) -> DataFrame:
    """Like `merge`, but a deleted row stays, marked with `_is_deleted` and `_deleted_at`."""
    never = F.lit(None).cast("timestamp_ntz")
    if "_is_deleted" not in target.columns:
        target = target.withColumns({"_is_deleted": F.lit(False), "_deleted_at": never})
    removed = change_rows.filter((F.col(ACTION) == DELETE) & ~F.col(IS_UPDATE)).select(*keys, F.lit(True).alias("_gone"))
    inserted = change_rows.filter(F.col(ACTION) == INSERT)
    marked = target.join(removed, keys, "left")
    # rows stored before the first deletion hold no mark
    before = F.coalesce("_is_deleted", F.lit(False))
    newly = F.coalesce("_gone", F.lit(False)) & ~before
    kept = marked.withColumns({
        "_deleted_at": F.when(newly, C.moment(at)).otherwise(F.col("_deleted_at")),
        "_is_deleted": before | newly,
    }).join(inserted.select(*keys), keys, "left_anti")
    fresh = inserted.withColumns({"_is_deleted": F.lit(False), "_deleted_at": never})
    return kept.select(*target.columns).unionByName(fresh.select(*target.columns))


def dedup(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the latest; ties are settled by the remaining columns."""
    return latest_per_key(df, keys, order)
