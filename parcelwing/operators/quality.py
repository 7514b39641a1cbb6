"""Data-quality operators: each turns check specifications into a result table.

All figures of one table come from one aggregate pass, which `stack` then
turns into one row per check.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwing.functions import columns as C
from parcelwing.operators.joins import orphans

PASS, FAIL, WARN = "PASS", "FAIL", "WARN - INVESTIGATE"


class KeySpec(NamedTuple):
    model: str
    columns: tuple[str, ...]


class RuleSpec(NamedTuple):
    """A row violates the rule when `violation` is true; null is no violation."""

    name: str
    model: str
    violation: Column


def verdict(passed: Column, otherwise: str = FAIL) -> Column:
    """A null condition, such as the sum over an empty table, does not pass."""
    return F.when(passed, PASS).otherwise(otherwise).alias("status")


def stacked(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def row_count(df: DataFrame) -> Column:
    """Number of rows as a scalar subquery."""
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


def counts_side_by_side(name_column: str, name: str, **tables: DataFrame) -> DataFrame:
    """One row: a name and the row count of each table.

    Each table is counted in its own aggregate and marked with its position;
    summing the marks avoids joining single-row results.
    """
    labels = list(tables)
    counted = stacked([
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("which"), "n") for label, df in tables.items()
    ])
    sums = [F.sum(F.when(F.col("which") == label, F.col("n"))).alias(label) for label in labels]
    return counted.agg(*sums).select(F.lit(name).alias(name_column), *labels)


def check_same_count(name_column: str, name: str, left: str, right: str, otherwise: str, **tables: DataFrame) -> DataFrame:
    counts = counts_side_by_side(name_column, name, **tables)
    return counts.withColumn("status", verdict(F.col(left) == F.col(right), otherwise))


def check_key(df: DataFrame, spec: KeySpec) -> DataFrame:
    """Rows against distinct keys; rows with a null key column count as rows only."""
    totals = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct(*spec.columns).alias("distinct_keys"),
    )
    return totals.select(
        F.lit(spec.model).alias("model"), F.lit("+".join(spec.columns)).alias("pk_column"),
        "total_rows", "distinct_keys", verdict(F.col("total_rows") == F.col("distinct_keys")),
    )


def check_rules(df: DataFrame, specs: list[RuleSpec], name_column: str, count_column: str) -> DataFrame:
    """Violations of all rules of one table, in one pass over it."""
    totals = df.agg(*[C.count_if(spec.violation).alias(f"_v{i}") for i, spec in enumerate(specs)])
    rows = F.stack(F.lit(len(specs)), *[x for i, s in enumerate(specs) for x in (F.lit(s.name), F.col(f"_v{i}"))])
    listed = totals.select(rows.alias(name_column, count_column))
    return listed.withColumn("status", verdict(F.col(count_column) == 0))


def check_orphans(name: str, child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows without a parent; an empty table has none and passes."""
    lost = orphans(child, child_key, parent, parent_key).agg(
        F.coalesce(F.sum("orphan_rows"), F.lit(0)).alias("orphan_count"))
    return lost.select(F.lit(name).alias("relationship"), "orphan_count", verdict(F.col("orphan_count") == 0))


def check_share(df: DataFrame, name: str, good: Column, passed) -> DataFrame:
    """Number and percentage of good rows; `passed` judges (total, good)."""
    totals = df.agg(F.count(F.lit(1)).alias("total_records"), C.count_if(good).alias("good_records"))
    total, ok = F.col("total_records"), F.col("good_records")
    return totals.select(
        F.lit(name).alias("check_name"), "total_records", "good_records",
        C.percent(ok, total).alias("pct_good"), verdict(passed(total, ok)),
    )


def profile(df: DataFrame, table: str, figures: dict[str, Column]) -> DataFrame:
    """Named figures of one table from one pass, as (table, figure, value) rows."""
    totals = df.agg(*[column.cast("bigint").alias(f"_f{i}") for i, column in enumerate(figures.values())])
    pairs = [x for i, name in enumerate(figures) for x in (F.lit(name), F.col(f"_f{i}"))]
    return totals.select(F.lit(table).alias("table"), F.stack(F.lit(len(figures)), *pairs).alias("figure", "value"))


class Finding(NamedTuple):
    """One report row: what was observed, what was expected, and the judgement."""

    group: str
    name: str
    observed: tuple[str, str] | int
    expected: tuple[str, str] | int
    status: Callable[[Column, Column], Column]


def report(figures: DataFrame, findings: list[Finding]) -> DataFrame:
    """Judge all findings from the figures: one small aggregate, then one row each."""
    wanted = dict.fromkeys(
        ref for f in findings for ref in (f.observed, f.expected) if isinstance(ref, tuple))
    names = {ref: f"_c{i}" for i, ref in enumerate(wanted)}
    cells = [
        F.max(F.when((F.col("table") == table) & (F.col("figure") == figure), F.col("value"))).alias(name)
        for (table, figure), name in names.items()
    ]

    def cell(ref) -> Column:
        return F.col(names[ref]) if isinstance(ref, tuple) else F.lit(ref).cast("bigint")

    rows = []
    for f in findings:
        observed, expected = cell(f.observed), cell(f.expected)
        rows += [F.lit(f.group), F.lit(f.name), observed, expected, f.status(observed, expected)]
    listed = F.stack(F.lit(len(findings)), *rows)
    return figures.agg(*cells).select(listed.alias("check_group", "check_name", "observed", "expected", "status"))
