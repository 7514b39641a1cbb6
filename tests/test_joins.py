"""The salted left join equals the plain one, whatever the limit."""

import random

import pytest

from pyspark.sql import functions as F

from parcelwing.operators.joins import crowded_keys, left_join


@pytest.mark.parametrize("hot_rows", [1, 7, 10**6])
def test_left_join_with_a_crowded_right_side(spark, hot_rows):
    rng = random.Random(hot_rows)
    keys = [f"k{i}" for i in range(20)] + [None]
    left = spark.createDataFrame([(k, i) for i, k in enumerate(keys + ["k0", "k5"])], "k string, l int")
    crowd = [("k0", i) for i in range(60)] + [(rng.choice(keys[:8] + [None]), 100 + i) for i in range(40)]
    right = spark.createDataFrame(crowd + [("elsewhere", 999)], "k string, r int")
    plain = left.join(right, "k", "left")
    salted = left_join(left, right, "k", ["r"], hot_rows=hot_rows)
    assert salted.columns == plain.columns
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_hot_rows_are_spread_over_salts(spark):
    left = spark.createDataFrame([("a",)], "k string")
    right = spark.range(1000).selectExpr("'a' as k", "id")
    got = left_join(left, right, "k", ["id"], hot_rows=100)
    assert got.count() == 1000
    assert "_salt" in got._jdf.queryExecution().optimizedPlan().toString()


def test_a_given_list_of_crowded_keys(spark):
    """The list may be right, empty, or out of date: the rows are those of the plain join."""
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4), ("a", 5)], "k string, l int")
    right = spark.createDataFrame([("a", i) for i in range(40)] + [("b", 90), ("x", 91)], "k string, r int")
    plain = sorted(map(str, left.join(right, "k", "left").collect()))
    assert crowded_keys(right, "k", hot_rows=10) == {"a": 40}
    for told in ({}, {"a": 40}, {"a": 40, "c": 1000, "gone": 50}, {"b": 31}):
        joined = left_join(left, right, "k", ["r"], hot_rows=10, crowded=told)
        assert sorted(map(str, joined.collect())) == plain
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        assert ("_salt" in plan) == bool(told) and "count(1)" not in plan


def test_a_mission_with_many_routes_is_salted(spark, context):
    """Statistics are taken when bronze is written; the fact's plan salts that mission and counts nothing."""
    from parcelwing.plans import gold
    from parcelwing.plans.layers import Layers
    from parcelwing.sources import adapter
    from parcelwing.sources.schemas import TABLES

    raw = {name: context.raw[name] for name in TABLES}
    one = raw["missions"].agg({"mission_id": "min"}).first()[0]
    copies = raw["routes"].filter(F.col("mission_id") == one).limit(1).withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(300))))
    crowd = copies.withColumn("route_id", F.concat("route_id", F.lit("-"), F.col("_i"))).drop("_i")
    raw["routes"] = raw["routes"].unionByName(crowd)
    layers = Layers(raw, adapter.AS_OF, adapter.LOAD_TS, adapter.TEST_LEXICON)
    lazy = layers.gold["fct_deliveries"]
    layers.silver.crowded = gold.crowded_parents(layers.bronze, hot_rows=100)
    assert set(layers.silver.crowded["routes of a mission"]) == {one}
    assert list(layers.silver.crowded["flights of an order"].values()) == [301]
    assert layers.silver.crowded["feedback of an order"] == {}
    salted = gold.fct_deliveries(layers.silver, adapter.AS_OF)
    plan = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "AS _rows" not in plan
    assert "AS _rows" not in lazy._jdf.queryExecution().optimizedPlan().toString()
    assert salted.exceptAll(lazy).isEmpty() and lazy.exceptAll(salted).isEmpty()
