"""Scalar helpers on edge values."""

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelwing import rules
from parcelwing.functions import columns as C


def one(spark, **named):
    row = spark.range(1).select(*[c.alias(n) for n, c in named.items()]).first()
    return row.asDict()


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_minutes_count_boundaries(spark):
    got = one(
        spark,
        crossing=C.minutes_between(ts("2024-01-01 00:00:59"), ts("2024-01-01 00:01:01")),
        inside=C.minutes_between(ts("2024-01-01 00:01:00"), ts("2024-01-01 00:01:59")),
        reverse=C.minutes_between(ts("2024-01-01 01:00:00"), ts("2024-01-01 00:58:30")),
        missing=C.minutes_between(ts("2024-01-01 01:00:00"), F.lit(None).cast("timestamp_ntz")),
        early=C.minutes_between(ts("1969-12-31 23:59:59"), ts("1970-01-01 00:00:01")),
    )
    assert got == {"crossing": 1, "inside": 0, "reverse": -2, "missing": None, "early": 1}


moments = st.datetimes(dt.datetime(1960, 1, 1), dt.datetime(2060, 1, 1))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(pairs=st.lists(st.tuples(moments, moments), min_size=1, max_size=30))
def test_boundary_differences_match_truncated_arithmetic(spark, pairs):
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    rows = df.select("a", "b", C.minutes_between("a", "b").alias("m"), C.seconds_between("a", "b").alias("s")).collect()
    for r in rows:
        minute = [t.replace(second=0, microsecond=0) for t in (r.a, r.b)]
        second = [t.replace(microsecond=0) for t in (r.a, r.b)]
        assert r.m == (minute[1] - minute[0]) // dt.timedelta(minutes=1)
        assert r.s == (second[1] - second[0]) // dt.timedelta(seconds=1)


def test_haversine(spark):
    def km(*xs):
        return C.haversine_km(*[F.lit(x).cast("double") for x in xs])

    got = one(spark, known=km(40.7127, -74.0059, 34.05, -118.25), same=km(10, 20, 10, 20),
              antipodes=km(0, 0, 0, 180), missing=km(None, 0, 1, 1))
    assert got["known"] == pytest.approx(3936.385096, abs=1e-6)
    assert got["same"] == 0.0
    assert got["antipodes"] == pytest.approx(math.pi * rules.EARTH_RADIUS_KM)
    assert got["missing"] is None


def test_rounding(spark):
    lit = F.lit
    got = one(spark, a=C.round_half_up(lit(1.005), 2), b=C.round_half_up(lit(0.285), 2), c=C.round_half_up(lit(2.5)),
              d=C.round_half_up(lit(-2.5)), e=C.round_half_even(lit(2.5)), f=C.round_half_even(lit(3.5)),
              g=C.round_half_up(lit(None).cast("double"), 1), h=C.round_half_up(lit(-0.2)))
    assert got == {"a": 1.0, "b": 0.28, "c": 3.0, "d": -3.0, "e": 2.0, "f": 4.0, "g": None, "h": 0.0}


def test_division_by_zero_is_null(spark):
    assert one(spark, q=C.safe_divide(F.lit(1.0), F.lit(0)), p=C.percent(F.lit(0), F.lit(0))) == {"q": None, "p": None}


@pytest.mark.parametrize("tiers,values", [
    (rules.USAGE_TIERS, [(1000.0, "MEDIUM"), (1000.1, "HIGH"), (500.0, "LOW"), (500.1, "MEDIUM"), (None, "LOW")]),
    (rules.MAINTENANCE_AGE_TIERS, [(90.0, "DUE_SOON"), (91.0, "OVERDUE"), (60.0, "CURRENT"), (61.0, "DUE_SOON")]),
    (rules.DEPOT_SIZES, [(20.0, "LARGE"), (19.0, "MEDIUM"), (10.0, "MEDIUM"), (9.0, "SMALL"), (None, "SMALL")]),
    (rules.ROUTE_CATEGORIES, [(50.0, "MEDIUM"), (50.1, "LONG"), (20.0, "SHORT"), (20.1, "MEDIUM"), (None, "SHORT")]),
])
def test_tiers_on_their_bounds(spark, tiers, values):
    df = spark.createDataFrame([(v,) for v, _ in values], "v double")
    assert [r[0] for r in df.select(C.tier("v", tiers)).collect()] == [label for _, label in values]


def test_text_and_null_rules(spark):
    df = spark.createDataFrame([("  a b\t ", 1, None), (None, 2, 5)], "t string, x int, y int")
    rows = df.select(C.canon("t").alias("t"), C.greatest_or_null("x", "y").alias("g"), C.flag(F.col("y") > 1).alias("f"),
                     C.element_or_null(F.array(F.lit(7)), F.col("x")).alias("e")).collect()
    assert [tuple(r) for r in rows] == [("A B\t", None, False, None), (None, 5, True, None)]


def test_fixed_sums_do_not_depend_on_order(spark):
    values = [0.1, 0.2, 1e7 + 0.3, -1e7, 0.7] * 40
    df = spark.createDataFrame([(v,) for v in values], "v double")
    results = {tuple(df.repartition(n).agg(C.fixed_sum("v", 1), C.fixed_avg("v", 1)).first()) for n in (1, 3, 7)}
    assert results == {(52.0, 0.26)}


def test_counts_over_nothing_are_null(spark):
    empty = spark.range(0)
    assert tuple(empty.agg(C.count_if(F.col("id") > 0), C.fixed_avg("id", 0)).first()) == (None, None)
