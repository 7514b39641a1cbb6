"""Ordered-window operators that do not gather a hot key in one task.

A plain partitioned window sends every row of a key to one task. Here a key is
cut into buckets by a value that follows the sort order (an hour, a key range):
rows are numbered within (key, bucket), one small summary row per (key, bucket)
carries the running totals, and joining the two gives the same answer. Buckets
depend on the data alone, so a retried task computes the same ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from parcelwing.functions import columns as C


def _zero(dtype: str) -> Column:
    """Stand-in for a null key; a null flag beside it keeps the two apart."""
    return F.lit("") if dtype == "string" else F.lit(0).cast(dtype)


def number_in_order(
    df: DataFrame,
    keys: list[str],
    ts: str,
    tie_break: list[str],
    number: str = "row_number",
    previous: str | None = None,
    unit: str = "hour",
    attributes: DataFrame | None = None,
) -> DataFrame:
    """Row number, and optionally the previous timestamp, per key by (ts, tie_break).

    `unit` is the length of a bucket: short enough that the rows of one key in
    one bucket fit a task, no shorter, because the summary grows with it.
    `attributes` is an optional table, joined inner to the summary rather than to
    the rows, so a hot key costs it nothing. A key that has several rows there
    shows each of its rows as often, numbered one after the other.

    The rows are grouped by columns that are never null. That lets numbering
    and the final join compare them with plain equality and share one shuffle;
    null-safe comparison would cost the rows a second one.
    """
    types = dict(df.dtypes)
    if attributes is None:
        flat = {f"_g{i}": F.coalesce(F.col(k), _zero(types[k])) for i, k in enumerate(keys)}
        flat |= {f"_null{i}": F.col(k).isNull() for i, k in enumerate(keys)}
    else:
        df = df.dropna(subset=keys)
        flat = {f"_g{i}": F.col(k) for i, k in enumerate(keys)}
    group = list(flat)
    bucket = F.coalesce(C.trunc_to(unit, ts), C.moment("0001-01-01 00:00:00"))
    bucketed = df.withColumns(flat | {"_bucket": bucket})

    inside = Window.partitionBy(*group, "_bucket").orderBy(ts, *tie_break)
    local = bucketed.withColumn("_n", F.row_number().over(inside))
    if previous:
        local = local.withColumn("_prev", F.lag(ts).over(inside))

    summary = bucketed.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_rows"), F.max(ts).alias("_last"))
    across = Window.partitionBy(*group).orderBy("_bucket")
    running = F.sum("_rows").over(across.rowsBetween(Window.unboundedPreceding, -1))
    summary = summary.select(
        *group, "_bucket",
        F.coalesce(running, F.lit(0)).alias("_before"),
        F.lag("_last").over(across).alias("_earlier"),
    )
    extra: list[str] = []
    if attributes is not None:
        extra = [c for c in attributes.columns if c not in keys]
        renamed = attributes.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], *extra)
        of_key = Window.partitionBy(*group)
        order = comparable(renamed, extra) or [F.lit(0)]
        repeated = renamed.withColumns({"_copy": F.row_number().over(of_key.orderBy(*order)), "_copies": F.count(F.lit(1)).over(of_key)})
        summary = summary.join(repeated, group)
    else:
        summary = summary.withColumns({"_copy": F.lit(1), "_copies": F.lit(1)})

    out = local.join(summary, [*group, "_bucket"])
    columns: list[Column] = [F.col(c) for c in (*df.columns, *extra)]
    place = F.col("_n") + F.col("_before")
    columns.append(((place - 1) * F.col("_copies") + F.col("_copy")).alias(number))
    if previous:
        last = F.when(F.col("_n") == 1, F.col("_earlier")).otherwise(F.col("_prev"))
        columns.append(F.when(F.col("_copy") > 1, F.col(ts)).otherwise(last).alias(previous))
    return out.select(*columns)


def number_globally(df: DataFrame, key: str, width: int, name: str = "rank") -> DataFrame:
    """Dense zero-based rank of a unique integer key over the whole table.

    Key ranges of `width` are ranked in parallel; only the per-range counts,
    one row each, pass through a single ordered window.
    """
    ranged = df.withColumn("_range", F.floor(F.col(key) / F.lit(float(width))))
    local = ranged.withColumn("_n", F.row_number().over(Window.partitionBy("_range").orderBy(key)))
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    ranked = local.join(offsets, "_range")
    return ranked.select(*df.columns, (F.col("_n") + F.col("_before") - 1).alias(name))


def comparable(df: DataFrame, columns: list[str], named: bool = True) -> list[Column]:
    """The columns in a form that has an order: variants as their JSON text."""

    def form(name: str) -> Column:
        if not isinstance(df.schema[name].dataType, VariantType):
            return df[name]
        return F.to_json(df[name]).alias(name) if named else F.to_json(df[name])

    return [form(name) for name in columns]


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one that comes last by `order`, then by all other columns.

    Spark applies the limit of one row before the shuffle as well, so a hot key
    sends one row per task; rows are sorted, never packed into aggregates.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    last = [F.desc(c) for c in order] + [c.desc() for c in comparable(df, rest, named=False)]
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*(last or [F.lit(0)])))
    return df.withColumn("_place", number).filter("_place = 1").drop("_place")
