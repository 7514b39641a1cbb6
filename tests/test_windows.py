"""Skew-safe windows against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from parcelwing.operators import summaries, windows

BASE = dt.datetime(2024, 1, 1)


def events(seed, rows=300):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", None]
    return [(rng.choice(keys), BASE + dt.timedelta(seconds=rng.randrange(0, 90000, 30)), i) for i in range(rows)]


def expected(data):
    out, last = {}, {}
    for key, ts, i in sorted(data, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2])):
        n, prev = last.get(key, (0, None))
        out[i] = (n + 1, prev)
        last[key] = (n + 1, ts)
    return out


@pytest.mark.parametrize("unit", ["minute", "hour", "day"])
def test_number_and_previous_per_key(spark, unit):
    data = events(unit)
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, id int")
    got = windows.number_in_order(df, ["k"], "ts", ["id"], number="n", previous="prev", unit=unit)
    assert {r.id: (r.n, r.prev) for r in got.collect()} == expected(data)


def test_attributes_join_and_drop_unknown_keys(spark):
    data = events(5)
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, id int")
    attributes = spark.createDataFrame([("hot", 1), ("a", 2)], "k string, size int")
    got = windows.number_in_order(df, ["k"], "ts", ["id"], number="n", attributes=attributes).collect()
    wanted = expected(data)
    assert {r.id: r.n for r in got} == {i: wanted[i][0] for k, _, i in data if k in ("hot", "a")}
    assert {(r.k, r["size"]) for r in got} == {("hot", 1), ("a", 2)}


def test_rows_without_a_timestamp_come_first(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", BASE, 2), ("a", None, 0)], "k string, ts timestamp_ntz, id int")
    got = windows.number_in_order(df, ["k"], "ts", ["id"], number="n")
    assert {r.id: r.n for r in got.collect()} == {0: 1, 1: 2, 2: 3}


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_global_rank(spark, width):
    keys = random.Random(1).sample(range(-500, 5000), 200)
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = windows.number_globally(df, "k", width)
    assert {r.k: r["rank"] for r in got.collect()} == {k: i for i, k in enumerate(sorted(keys))}


def test_latest_per_key_settles_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 0, "z"), ("b", 5, None)], "k string, v int, t string")
    assert sorted(map(tuple, windows.latest_per_key(df, ["k"], ["v"]).collect())) == [("a", 1, "y"), ("b", 5, None)]


def test_ordered_arrays_are_bounded_and_whole(spark):
    data = [("hot", BASE + dt.timedelta(minutes=37 * (i % 50)), i) for i in range(95)] + [("b", BASE, 1000)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, v int")
    rows = summaries.ordered_arrays(df, "k", "ts", "v", unit="hour", chunk=10).collect()
    assert max(len(r["items"]) for r in rows) == 10
    hot = [v for r in sorted((r for r in rows if r.k == "hot"), key=lambda r: r.chunk) for v in r["items"]]
    assert hot == [v for _, _, v in sorted(data[:-1], key=lambda r: (r[1], r[2]))]


def test_rows_are_shuffled_once(spark):
    """The window and the join with the summary share one partitioning."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame(events(3), "k string, ts timestamp_ntz, id int").withColumn("payload", F.lit("p"))
        got = windows.number_in_order(df, ["k"], "ts", ["id"], previous="prev")
        plan = got._jdf.queryExecution().executedPlan().toString()
        joined = plan[plan.index("SortMergeJoin"):plan.index("Window [row_number")]
        assert "Exchange" not in joined
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repeated_attribute_rows_are_numbered_one_after_the_other(spark):
    """As if the attributes were joined first and the rows numbered then."""
    data = [("a", BASE + dt.timedelta(seconds=60 * i), i) for i in (0, 1, 70)] + [("b", BASE, 5)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, id int")
    attributes = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, size int")
    got = windows.number_in_order(df, ["k"], "ts", ["id"], number="n", previous="prev", attributes=attributes).collect()
    a = sorted((r.n, r.ts, r.prev) for r in got if r.k == "a")
    times = [ts for k, ts, _ in data if k == "a" for _ in range(2)]
    assert a == [(n, ts, prev) for n, (ts, prev) in enumerate(zip(times, [None, *times]), 1)]
    assert [(r.n, r.prev) for r in got if r.k == "b"] == [(1, None)]
