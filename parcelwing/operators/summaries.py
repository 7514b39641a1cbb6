"""Aggregations and ordered selections of the report layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwing.functions import columns as C
from parcelwing.operators.windows import number_in_order

SKETCH = 10_000         # a sketch's ranks are wrong by one in so many
MARGIN = 2 / SKETCH


def group_size(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    """Rows per non-null key."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    """Frequency of each non-null value, most frequent first."""
    return group_size(df, column, name).orderBy(F.desc(name), column)


def top_k(df: DataFrame, by: str, key: str, k: int = 10) -> DataFrame:
    """The k rows with the largest value; the key settles ties."""
    return df.orderBy(F.desc_nulls_last(by), key).limit(k)


def median(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Exact interpolated median per key, no task holding the values of a key.

    A mergeable sketch per key gives two bounds whose ranks are wrong by one in
    10,000 at most, taken far enough apart to hold the middle for certain. Rows
    below the bounds are only counted, those above dropped; what lies between, a
    few in ten thousand, is put in order by value and frequency.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_value"))
    ends = F.percentile_approx("_value", F.array(F.lit(0.5 - MARGIN), F.lit(0.5 + MARGIN)), F.lit(SKETCH))
    names = [f"_k{i}" for i in range(len(keys))]
    bounds = rows.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(
        ends.alias("_ends"), F.count(F.lit(1)).alias("_of"))
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    near = rows.join(bounds, same).filter(F.col("_value") <= F.col("_ends")[1])
    inside = F.when(F.col("_value") >= F.col("_ends")[0], F.col("_value")).alias("_inside")
    counted = near.groupBy(*keys, "_of", inside).agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_inside")).rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("_upto", F.sum("_n").over(order)).filter(F.col("_inside").isNotNull())

    def at(rank: str) -> Column:
        return F.min(F.when(F.col("_upto") >= F.expr(rank), F.col("_inside"))).cast("double")

    middle = placed.groupBy(*keys).agg(at("(_of + 1) div 2").alias("_a"), at("_of div 2 + 1").alias("_b"))
    return middle.select(*keys, (F.col("_a") * 0.5 + F.col("_b") * 0.5).alias(name))


def status_counts(df: DataFrame, key: str, status: str, names: dict[str, str]) -> DataFrame:
    """Per key, the number of rows in each named status, side by side."""
    counts = [C.count_if(F.col(status) == value).alias(name) for value, name in names.items()]
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*counts)


def _bin_step(low: Column, high: Column, most: int) -> Column:
    """Smallest step of the form {1, 2, 5} x 10^n that needs at most `most` bins; 1e-6 where all values are equal.

    The step exceeds a `most`-th of the extent, which gives n to within two.
    """
    power = F.coalesce(F.floor(F.log10(F.nullif(high - low, F.lit(0.0)) / most)), F.lit(-6)).cast("int")
    powers = F.when(high == low, F.sequence(power, power)).otherwise(F.sequence(power, power + 2))
    spelled = F.flatten(F.transform(powers, lambda n: F.array(*[F.concat(F.lit(f"{m}e"), n.cast("string")) for m in (1, 2, 5)])))
    steps = F.transform(spelled, lambda text: text.cast("double"))
    fits = F.filter(steps, lambda s: F.floor(high / s) - F.floor(low / s) < most)
    return F.array_min(fits)


def histogram(df: DataFrame, value: str, most: int = 30) -> DataFrame:
    """Frequencies in at most `most` equal bins with a round width.

    The values are counted first; the extent and the bins are then taken from
    that small table.
    """
    counted = group_size(df, value, "_n")
    extent = counted.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
    step = extent.select(_bin_step(F.col("lo"), F.col("hi"), most)).scalar()
    binned = counted.withColumn("_step", step).withColumn("_bin", F.floor(F.col(value) / F.col("_step")))
    grouped = binned.groupBy("_bin", "_step").agg(F.sum("_n").alias("frequency"))
    return grouped.select(
        (F.col("_bin") * F.col("_step")).alias("bin_start"),
        ((F.col("_bin") + 1) * F.col("_step")).alias("bin_end"),
        "frequency",
    )


def bounded_sample(df: DataFrame, order: Column, key: str, rows: int = 1000) -> DataFrame:
    """At most `rows` rows, the same ones on every run: smallest keyed hash first."""
    return df.orderBy(order, key).limit(rows)


def ordered_arrays(df: DataFrame, key: str, ts: str, value: str, unit: str, chunk: int = 1000) -> DataFrame:
    """Values per key as arrays in (ts, value) order, cut into chunks of bounded length.

    A key with more than `chunk` values has several rows, numbered from 0, so
    no array and no task ever holds an unbounded group.
    """
    numbered = number_in_order(df.select(key, ts, value), [key], ts, [value], number="_n", unit=unit)
    placed = numbered.withColumn("chunk", F.floor((F.col("_n") - 1) / float(chunk)))
    collected = placed.groupBy(key, "chunk").agg(F.sort_array(F.collect_list(F.struct("_n", value))).alias("_items"))
    return collected.select(key, "chunk", F.transform("_items", lambda item: item[value]).alias("items"))
