"""Tables, stored intermediate results and batch helpers shared by the text operators."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelwing.session import scratch


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, whatever folder they start in."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write df below the shared folder and read it back.

    This cuts the lineage: a lost executor costs the tasks of one step only,
    and what Python made is not made twice. Sizes of the files also tell
    Spark's planner which side of a later join is small.
    """
    path = scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: str = "text"):
    """128-bit key of a text as a pair of columns' struct; null like the text."""
    return F.when(F.col(text).isNotNull(), F.struct(
        F.xxhash64(text).alias("lo"), F.xxhash64(F.lit(7), F.col(text)).alias("hi")))


def numbered(rows: DataFrame, keys: list[str], bucket: str, order: list[str], name: str) -> DataFrame:
    """Running number from 0 within keys by (bucket, order), no task seeing more than one bucket.

    Rows are numbered inside a bucket; a bucket's first number is the count of
    the buckets before it, from a table of one row per bucket.
    """
    inside = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, bucket).orderBy(*order)) - 1)
    counts = rows.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    return inside.join(starts, [*keys, bucket]).withColumn(name, F.col("_before") + F.col("_n")).drop("_n", "_before")


def plain(name: str) -> str:
    """Column name quoted for select, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def set_apart(docs: DataFrame, results: tuple[str, ...]) -> tuple[list[Column], list[Column]]:
    """The columns of docs that an operator passes on, and the same under their own names again at its end.

    An operator's own columns start with a line; columns of docs that do so too
    travel under other names. Those named like a result are left out.
    """
    passed, named = [], []
    for number, name in enumerate(c for c in docs.columns if c not in results):
        other = f"passed{number}"
        while other in docs.columns:
            other += "x"
        travelling = other if name.startswith("_") else name
        passed.append(F.col(plain(name)).alias(travelling))
        named.append(F.col(plain(travelling)).alias(name))
    return passed, named


def bounded(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a text column holds about most_bytes at most; one long text still makes one batch."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, total = 0, 0
        for row, length in enumerate(lengths):
            if row > start and total + length > most_bytes:
                yield batch.slice(start, row - start)
                start, total = row, 0
            total += length
        if len(lengths) > start:
            yield batch.slice(start)


def encoded(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a text column, nulls as empty."""
    return [value or b"" for value in batch.column(column).cast(pa.binary()).to_pylist()]
