"""Silver and gold models on hand-made rows, each value on its edge."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from parcelwing.operators import summaries
from parcelwing.plans import gold, silver
from parcelwing.plans.bronze import to_bronze
from parcelwing.plans.layers import Layers
from parcelwing.sources import adapter
from parcelwing.sources.schemas import TABLES, source_tag

AS_OF = dt.datetime(2024, 1, 31)
LOAD = dt.datetime(2024, 1, 31, 6)


def rows_of(spark, table, *rows):
    """Bronze rows from partial dictionaries; missing columns are null."""
    names = TABLES[table].names
    raw = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], TABLES[table].columns)
    return {table: to_bronze(raw, table, LOAD)}


def column(df, name):
    return [r[name] for r in df.collect()]


def test_bronze_adds_load_metadata(spark):
    row = rows_of(spark, "depots", {"depot_id": "d"})["depots"].first()
    assert (row._loaded_at, row._source_file, row._dbt_loaded_at) == (LOAD, "DEPOT.DEPOTS", LOAD)
    assert source_tag("flight_logs") == "FLV6.FLIGHT_LOGS"


@pytest.mark.parametrize("table", list(TABLES))
def test_rows_without_a_key_are_dropped(spark, table):
    if table == "delivery_feedback":
        present = {"feedback_id": "x", "comments": "fine"}
    else:
        present = {TABLES[table].key: "x"}
    df = silver.FROM_BRONZE[f"silver_{table}"](rows_of(spark, table, present, {}), AS_OF)
    assert df.count() == 1


def test_flight_flags_use_unrounded_values(spark):
    logs = [{"flight_log_id": str(i), "battery_pct": b, "speed_kmh": s, "altitude_m": a} for i, (b, s, a) in enumerate([
        (10.0, 120.0, 400.0), (9.96, 0.0, 0.0), (50.0, 120.04, 0.0), (50.0, 0.0, 400.01), (None, None, None)])]
    got = silver.flight_logs(rows_of(spark, "flight_logs", *logs), AS_OF).orderBy("flight_log_id").collect()
    flags = [(r.is_low_battery, r.is_overspeed, r.is_high_altitude, r.has_anomaly) for r in got]
    assert flags == [(False,) * 4, (True, False, False, True), (False, True, False, True),
                     (False, False, True, True), (False,) * 4]
    assert got[1].battery_pct == 10.0


def test_weather_severity_bounds(spark):
    cases = [
        ((50.0, 5.0, 0.0), "MODERATE", True), ((50.1, 9.0, 0.0), "SEVERE", False), ((0.0, 0.9, 0.0), "SEVERE", False),
        ((0.0, 9.0, 20.1), "SEVERE", True), ((0.0, 1.0, 0.0), "MODERATE", True), ((15.1, 9.0, 0.0), "MILD", True),
        ((15.0, 5.0, 5.0), "CLEAR", True), ((None, None, None), "CLEAR", True), ((None, 0.5, None), "SEVERE", False),
    ]
    rows = [{"weather_id": f"{i:02}", "wind_speed_kmh": w, "visibility_km": v, "precipitation_mm": p}
            for i, ((w, v, p), _, _) in enumerate(cases)]
    got = silver.weather_data(rows_of(spark, "weather_data", *rows), AS_OF).orderBy("weather_id").collect()
    assert [(r.weather_severity, r.is_flyable) for r in got] == [(s, f) for _, s, f in cases]


def test_aircraft_maintenance_and_usage(spark):
    ages = [(90, "DUE_SOON"), (91, "OVERDUE"), (60, "CURRENT"), (61, "DUE_SOON"), (None, "UNKNOWN")]
    rows = [{"aircraft_id": str(i), "last_maintenance_date": None if a is None else AS_OF.date() - dt.timedelta(days=a)}
            for i, (a, _) in enumerate(ages)]
    got = silver.aircraft(rows_of(spark, "aircraft", *rows), AS_OF).orderBy("aircraft_id")
    assert column(got, "maintenance_status") == [label for _, label in ages]


def test_stock_status_and_unit_cost(spark):
    stock = [(10, 10, "REORDER_NEEDED"), (15, 10, "LOW_STOCK"), (16, 10, "IN_STOCK"), (None, 10, "IN_STOCK")]
    rows = [{"part_id": str(i), "quantity_on_hand": q, "reorder_level": r} for i, (q, r, _) in enumerate(stock)]
    got = silver.parts_inventory(rows_of(spark, "parts_inventory", *rows), AS_OF).orderBy("part_id")
    assert column(got, "stock_status") == [s for _, _, s in stock]
    used = silver.parts_used(rows_of(spark, "parts_used", {"usage_id": "a", "quantity_used": 0, "cost": 5.0},
                                     {"usage_id": "b", "quantity_used": 3, "cost": 10.0}), AS_OF).orderBy("usage_id")
    assert column(used, "cost_per_unit") == [None, 3.33]


def test_route_speed_needs_distance_and_time(spark):
    rows = [{"route_id": str(i), "distance_km": d, "duration_min": t} for i, (d, t) in enumerate([(30.0, 45.0), (0.0, 5.0), (5.0, 0.0), (None, 5.0)])]
    got = silver.routes(rows_of(spark, "routes", *rows), AS_OF).orderBy("route_id")
    assert column(got, "avg_speed_kmh") == [40.0, None, None, None]
    assert column(got, "route_category") == ["MEDIUM", "SHORT", "SHORT", "SHORT"]


def test_word_classes_and_defaults(spark):
    kinds = [(" crash ", "CRITICAL"), ("reroute", "WARNING"), ("Landing", "INFO"), ("lunch", "UNKNOWN"), (None, "UNKNOWN")]
    rows = [{"event_id": str(i), "event_type": k} for i, (k, _) in enumerate(kinds)]
    got = silver.mission_events(rows_of(spark, "mission_events", *rows), AS_OF).orderBy("event_id")
    assert column(got, "severity") == [s for _, s in kinds]
    zones = silver.delivery_zones(rows_of(spark, "delivery_zones", {"zone_id": "a"}, {"zone_id": "b", "is_active": False}), AS_OF)
    assert column(zones.orderBy("zone_id"), "is_active") == [True, False]
    ends = [None, AS_OF, AS_OF + dt.timedelta(seconds=1)]
    nfz = silver.no_fly_zones(rows_of(spark, "no_fly_zones", *[{"nfz_id": str(i), "effective_to": e} for i, e in enumerate(ends)]), AS_OF)
    assert column(nfz.orderBy("nfz_id"), "is_currently_active") == [True, False, True]


def tiny_silver(spark):
    """Three orders: one with mission, route and two comments; one without route; one alone."""
    t = dt.datetime(2024, 1, 1, 10)
    orders = [{"order_id": o, "customer_id": "c", "status": s, "created_at": t, "delivered_at": d} for o, s, d in [
        ("o1", "delivered", t + dt.timedelta(minutes=30)), ("o2", "delivered", t + dt.timedelta(minutes=41)), ("o3", "cancelled", None)]]
    missions = [{"mission_id": "m1", "order_id": "o1", "aircraft_id": "a1", "status": "completed"},
                {"mission_id": "m2", "order_id": "o2", "aircraft_id": "a1", "status": "completed"},
                {"mission_id": "m3", "order_id": None, "aircraft_id": "a2", "status": "failed"}]
    routes = [{"route_id": "r1", "mission_id": "m1", "distance_km": 12.0, "duration_min": 10.0}]
    notes = [{"feedback_id": f, "order_id": "o1", "customer_id": "c", "rating": r, "comments": c} for f, r, c in [
        ("f1", 5, "great and fast"), ("f2", 2, "late"), ("f3", 1, None)]]
    bronze = {}
    for name, data in (("orders", orders), ("missions", missions), ("routes", routes), ("delivery_feedback", notes)):
        bronze |= rows_of(spark, name, *data)
    return {f"silver_{n}": silver.FROM_BRONZE[f"silver_{n}"](bronze, AS_OF) for n in bronze}


def test_deliveries_fan_out_with_feedback_and_keep_every_order(spark):
    facts = gold.fct_deliveries(tiny_silver(spark), AS_OF)
    got = sorted((r.order_id, r.mission_id, r.route_category, r.feedback_rating) for r in facts.collect() if r.order_id != "o3")
    assert got == [("o1", "m1", "SHORT", 2), ("o1", "m1", "SHORT", 5), ("o2", "m2", None, None)]
    assert facts.filter("order_id = 'o3' and mission_id is null").count() == 1


def test_daily_kpi(spark):
    facts = gold.fct_deliveries(tiny_silver(spark), AS_OF)
    row = gold.kpi_delivery_performance({"fct_deliveries": facts}, AS_OF).first()
    assert (row.total_orders, row.delivered_orders, row.cancelled_orders, row.active_aircraft) == (4, 3, 1, 1)
    assert row.delivery_success_rate_pct == 75.0
    assert row.median_delivery_time_min == 30.0
    assert row.avg_delivery_time_min == pytest.approx((30 + 30 + 41) / 3)
    assert row.avg_customer_rating == 3.5 and row.avg_sentiment_score == 0.0


def test_kpi_agrees_with_the_one_step_aggregate(context):
    facts = context.gold["fct_deliveries"]
    day = F.date_trunc("day", "order_created_at").cast("timestamp_ntz").alias("report_date")
    plain = facts.groupBy(day).agg(F.median("delivery_time_min").alias("median_delivery_time_min"),
                                   F.countDistinct("aircraft_id").alias("active_aircraft"))
    kpi = gold.kpi_delivery_performance({"fct_deliveries": facts}, AS_OF).select(plain.columns)
    assert kpi.exceptAll(plain).isEmpty() and plain.exceptAll(kpi).isEmpty()


def test_silver_may_see_only_the_row_loaded_last(spark, context):
    """Every table with all its rows loaded twice, the second time changed: silver has one row a key, the later."""
    raw = {name: context.raw[name] for name in TABLES}
    layers = Layers(raw, adapter.AS_OF, adapter.LOAD_TS, adapter.TEST_LEXICON, newest=tuple(TABLES))
    for name, table in TABLES.items():
        later = layers.bronze[name].withColumn("_loaded_at", F.col("_loaded_at") + F.expr("interval 1 day"))
        changed = later.withColumn("_dbt_loaded_at", later["_loaded_at"])
        layers.bronze.replace(name, layers.bronze[name].unionByName(changed))
        once = layers.live[name]
        assert once.count() == context.bronze[name].select(table.key).distinct().count(), name
        assert once.filter(F.col("_loaded_at") != F.col("_dbt_loaded_at")).isEmpty()
    assert layers.silver["silver_orders"].count() == context.silver["silver_orders"].count()
    plan = layers.live["orders"]._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "SortAggregate" not in plan


def test_median_of_crowded_keys(spark):
    """Ties, even and odd counts, nulls, a null key, and a key with very many values."""
    import statistics

    rows = [("a", 1.0), ("a", 2.0), ("b", 5.0), ("c", None), (None, 7.0), (None, 9.0), (None, 9.0)]
    rows += [("hot", float((k * 7919) % 30011) ** 2) for k in range(30_011)] + [("tied", 3.0)] * 500 + [("tied", 4.0)] * 500
    got = summaries.median(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", "m")
    held = {}
    for k, v in rows:
        if v is not None:
            held.setdefault(k, []).append(v)
    assert {r.k: r.m for r in got.collect()} == {k: statistics.median(v) for k, v in held.items()}
    crowd = spark.range(10_000_000).selectExpr("id % 2 AS k", "cast(id * 48271 % 2147483647 AS double) AS v")
    middle = {r.k: r.m for r in summaries.median(crowd, ["k"], "v", "m").collect()}
    exact = crowd.groupBy("k").agg(F.percentile("v", F.lit(0.5)).alias("m"))
    assert middle == {r.k: r.m for r in exact.collect()}
