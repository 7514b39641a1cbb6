"""Values and columns that the test tables do not hold."""

import math

from parcelwing.functions import columns as C
from parcelwing.operators import cdc, shaping, summaries
from pyspark.sql import functions as F


def test_rounding_keeps_nan_and_large_values(spark):
    df = spark.createDataFrame([(float("nan"),), (1e300,), (float("inf"),), (-2.345,), (None,)], "x double")
    got = [r[0] for r in df.select(C.round_half_up("x", 2)).collect()]
    assert math.isnan(got[0]) and got[1:] == [1e300, float("inf"), -2.35, None]


def test_histogram_step_follows_the_extent(spark):
    for values in ([0.0, 1e15], [0.0, 3e-12], [5.0, 5.0], [-1e9, 2e9, 0.0]):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        bins = summaries.histogram(df, "x").collect()
        assert sum(b.frequency for b in bins) == len(values) and all(b.bin_start is not None for b in bins)
        assert all(any(b.bin_start <= v <= b.bin_end for b in bins) for v in values)


def test_round_robin_ranks_members(spark):
    members = spark.createDataFrame([(10, "a"), (20, "b")], "k long, name string")
    rows = spark.range(6)
    got = [(r.id, r.name) for r in shaping.assign_round_robin(rows, "id", members, "k", ["name"]).orderBy("id").collect()]
    assert got == [(i, "ab"[i % 2]) for i in range(6)]


def test_changes_with_a_variant_column(spark):
    table = lambda rows: spark.createDataFrame(rows, "k int, w string").select("k", F.parse_json("w").alias("w"))
    v0, v1, v2 = table([(1, "[1]"), (2, "[2]")]), table([(1, "[1]"), (2, "[3]"), (3, "[4]")]), table([(1, "[5]"), (3, "[4]")])
    first = cdc.changes(v0, v1, ["k"]).withColumn("version", F.lit(1))
    second = cdc.changes(v1, v2, ["k"]).withColumn("version", F.lit(2))
    shown = lambda df: sorted((r.k, r.w, r[2]) for r in df.select("k", F.to_json("w").alias("w"), cdc.ACTION).collect())
    assert shown(first) == [(2, "[2]", "DELETE"), (2, "[3]", "INSERT"), (3, "[4]", "INSERT")]
    net = cdc.net(first.unionByName(second), ["k"], "version")
    assert shown(net) == [(1, "[1]", "DELETE"), (1, "[5]", "INSERT"), (2, "[2]", "DELETE"), (3, "[4]", "INSERT")]
    twice = v0.withColumn("at", F.lit(1)).unionByName(v1.withColumn("at", F.lit(2)))
    assert cdc.dedup(twice, ["k"], ["at"]).count() == 3
