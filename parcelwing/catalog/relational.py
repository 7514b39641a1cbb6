"""Queries: filters, joins, aggregates, windows, ordering and set operators."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import functions as F

from parcelwing import rules
from parcelwing.catalog.domain_sql import count_if, favg, fsum, pct
from parcelwing.catalog.registry import query
from parcelwing.functions import columns as C
from parcelwing.operators import filters, joins, shaping, summaries, windows
from parcelwing.plans.gold import dim_aircraft

START, END = dt.date(1996, 3, 1), dt.date(1999, 6, 30)
DEPOT_NAME = "Supplier#000000003"


# --- filters ----------------------------------------------------------------
@query("require_key", "SELECT customer_id, email FROM raw_customers WHERE customer_id IS NOT NULL")
def _require_key(c):
    return filters.require(c.raw["customers"], "customer_id").select("customer_id", "email")


@query("require_text", "SELECT feedback_id, length(comments) AS n_chars FROM raw_delivery_feedback "
                       "WHERE feedback_id IS NOT NULL AND comments IS NOT NULL")
def _require_text(c):
    kept = filters.require(c.raw["delivery_feedback"], "feedback_id", "comments")
    return kept.select("feedback_id", F.length("comments").cast("bigint").alias("n_chars"))


@query("filter_equals", "SELECT order_id, delivered_at FROM silver_orders WHERE order_status = 'DELIVERED'")
def _filter_equals(c):
    return c.silver["silver_orders"].filter(F.col("order_status") == "DELIVERED").select("order_id", "delivered_at")


@query("filter_not_null_ts", "SELECT mission_id, actual_departure FROM raw_missions WHERE actual_departure IS NOT NULL")
def _filter_not_null_ts(c):
    return filters.require(c.raw["missions"], "actual_departure").select("mission_id", "actual_departure")


@query("filter_latest_date", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def _filter_latest_date(c):
    return filters.latest(c.table("orders").select("o_orderkey", "o_orderdate"), "o_orderdate")


@query("filter_date_range", f"SELECT o_orderkey, o_orderdate FROM orders WHERE CAST(o_orderdate AS DATE) "
                            f"BETWEEN DATE '{START}' AND DATE '{END}'")
def _filter_date_range(c):
    return filters.between_days(c.table("orders").select("o_orderkey", "o_orderdate"), "o_orderdate", START, END)


@query("filter_depot", f"SELECT mission_id, aircraft_id FROM silver_missions WHERE aircraft_id IN "
                       f"(SELECT aircraft_id FROM silver_aircraft JOIN silver_depots USING (depot_id) "
                       f"WHERE depot_name = '{DEPOT_NAME}')")
def _filter_depot(c):
    fleet = filters.fleet_of_depot(c.silver["silver_aircraft"], c.silver["silver_depots"], DEPOT_NAME)
    return filters.flown_by(c.silver["silver_missions"], fleet).select("mission_id", "aircraft_id")


@query("filter_drop_null", "SELECT mission_id, actual_duration_min, notes FROM silver_missions "
                           "WHERE actual_duration_min IS NOT NULL AND notes IS NOT NULL")
def _filter_drop_null(c):
    return filters.require(c.silver["silver_missions"], "actual_duration_min", "notes").select(
        "mission_id", "actual_duration_min", "notes")


# --- joins ------------------------------------------------------------------
@query("inner_join", "SELECT event_id, mission_id, event_type, mission_status "
                     "FROM silver_mission_events JOIN silver_missions USING (mission_id)")
def _inner_join(c):
    missions = c.silver["silver_missions"].select("mission_id", "mission_status")
    return c.silver["silver_mission_events"].join(missions, "mission_id").select(
        "event_id", "mission_id", "event_type", "mission_status")


@query("inner_join_fk", "SELECT mission_id, order_id, customer_id, priority FROM raw_missions JOIN raw_orders USING (order_id)")
def _inner_join_fk(c):
    orders = c.raw["orders"].select("order_id", "customer_id", "priority")
    return c.raw["missions"].join(orders, "order_id").select("mission_id", "order_id", "customer_id", "priority")


@query("left_join_chain", "SELECT aircraft_id, depot_name, total_missions, total_maintenance_events FROM dim_aircraft")
def _left_join_chain(c):
    chain = dim_aircraft(c.silver, c.layers.as_of)
    return chain.select("aircraft_id", "depot_name", "total_missions", "total_maintenance_events")


@query("left_join_transitive", "SELECT o.order_id, m.mission_id, r.route_id FROM raw_orders o "
                               "LEFT JOIN raw_missions m USING (order_id) LEFT JOIN raw_routes r ON r.mission_id = m.mission_id")
def _left_join_transitive(c):
    routes = c.raw["routes"].select("route_id", "mission_id")
    missions = c.raw["missions"].select("mission_id", "order_id")
    crowded = joins.crowded_keys(routes, "mission_id")
    routed = joins.left_join(missions, routes, "mission_id", ["route_id"], crowded=crowded)
    orders = c.raw["orders"].select("order_id")
    joined = joins.left_join(orders, routed, "order_id", ["mission_id", "route_id"],
                             crowded=joins.crowded_keys(routed, "order_id"))
    return joined.select("order_id", "mission_id", "route_id")


@query("cross_join", "SELECT mission_id, event_seq FROM raw_missions, (SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8]) AS event_seq)")
def _cross_join(c):
    """Entity x template: the fixed template rides in the projection, nothing is joined."""
    rows = [(number,) for number, _, _ in rules.MILESTONES]
    return shaping.expand(c.raw["missions"].select("mission_id"), rows, ("event_seq",))


@query("expr_equi_join", "SELECT o_orderkey, aircraft_id, serial_number FROM orders JOIN raw_aircraft "
                         "ON aircraft_id = 'AC-' || ((o_orderkey * 31) % (SELECT count(*) FROM customer))")
def _expr_equi_join(c):
    total = c.table("customer").agg(F.count(F.lit(1)).alias("n")).scalar()
    slot = F.concat(F.lit("AC-"), ((F.col("o_orderkey") * 31) % total).cast("string"))
    keyed = c.table("orders").select("o_orderkey", slot.alias("aircraft_id"))
    return keyed.join(c.raw["aircraft"].select("aircraft_id", "serial_number"), "aircraft_id").select(
        "o_orderkey", "aircraft_id", "serial_number")


@query("anti_join_orphans", "SELECT mission_id, count(*) AS orphan_rows FROM raw_mission_events e WHERE NOT EXISTS "
                            "(SELECT 1 FROM raw_missions m WHERE m.mission_id = e.mission_id) GROUP BY mission_id")
def _anti_join_orphans(c):
    return joins.orphans(c.raw["mission_events"], "mission_id", c.raw["missions"], "mission_id")


@query("semi_join_isin", "SELECT mission_id, aircraft_id FROM raw_missions WHERE aircraft_id IN "
                         "(SELECT aircraft_id FROM silver_aircraft WHERE aircraft_status = 'ACTIVE')")
def _semi_join_isin(c):
    active = c.silver["silver_aircraft"].filter(F.col("aircraft_status") == "ACTIVE")
    return filters.flown_by(c.raw["missions"].select("mission_id", "aircraft_id"), active).select("mission_id", "aircraft_id")


# --- aggregates -------------------------------------------------------------
_N = F.count


def _rows():
    return F.count(F.lit(1))


@query("count_all", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def _count_all(c):
    return c.table("lineitem").groupBy("l_returnflag", "l_linestatus").agg(_rows().alias("n"))


@query("count_distinct", "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def _count_distinct(c):
    return c.table("events").groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))


@query("conditional_count", f"SELECT customer_id, {count_if('order_status = ' + chr(39) + 'DELIVERED' + chr(39))} AS delivered, "
                            f"{count_if('delivered_at IS NULL')} AS open_orders FROM silver_orders GROUP BY customer_id")
def _conditional_count(c):
    return c.silver["silver_orders"].groupBy("customer_id").agg(
        C.count_if(F.col("order_status") == "DELIVERED").alias("delivered"),
        C.count_if(F.col("delivered_at").isNull()).alias("open_orders"))


@query("sum_", f"SELECT l_returnflag, {fsum('l_extendedprice', 2)} AS sum_price, {fsum('l_quantity', 0)} AS sum_qty "
               "FROM lineitem GROUP BY l_returnflag")
def _sum(c):
    return c.table("lineitem").groupBy("l_returnflag").agg(
        C.fixed_sum("l_extendedprice", 2).alias("sum_price"), C.fixed_sum("l_quantity", 0).alias("sum_qty"))


@query("avg_", f"SELECT l_suppkey, {favg('l_extendedprice', 2)} AS avg_price, {favg('l_discount', 2)} AS avg_discount "
               "FROM lineitem GROUP BY l_suppkey")
def _avg(c):
    return c.table("lineitem").groupBy("l_suppkey").agg(
        C.fixed_avg("l_extendedprice", 2).alias("avg_price"), C.fixed_avg("l_discount", 2).alias("avg_discount"))


@query("min_max", "SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, min(value) AS low, max(value) AS high "
                  "FROM events GROUP BY user_id")
def _min_max(c):
    return c.table("events").groupBy("user_id").agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.min("value").alias("low"), F.max("value").alias("high"))


@query("median_exact", "SELECT l_suppkey, median(l_quantity) AS median_qty FROM lineitem GROUP BY l_suppkey")
def _median_exact(c):
    return summaries.median(c.table("lineitem"), ["l_suppkey"], "l_quantity", "median_qty")


_DELIVERED = count_if("order_status = 'DELIVERED'")


@query("ratio_pct", f"SELECT priority, {pct(_DELIVERED, 'count(*)')} AS delivered_pct FROM silver_orders GROUP BY priority")
def _ratio_pct(c):
    delivered = C.count_if(F.col("order_status") == "DELIVERED")
    return c.silver["silver_orders"].groupBy("priority").agg(C.percent(delivered, _rows()).alias("delivered_pct"))


@query("group_by_key", f"SELECT o_custkey, count(*) AS n, {fsum('o_totalprice', 2)} AS total FROM orders GROUP BY o_custkey")
def _group_by_key(c):
    return c.table("orders").groupBy("o_custkey").agg(_rows().alias("n"), C.fixed_sum("o_totalprice", 2).alias("total"))


@query("group_by_key_hour", "SELECT user_id, date_trunc('hour', ts) AS hour_ts, count(*) AS n, max(value) AS high "
                            "FROM events GROUP BY ALL")
def _group_by_key_hour(c):
    return c.table("events").groupBy("user_id", C.trunc_to("hour", "ts").alias("hour_ts")).agg(
        _rows().alias("n"), F.max("value").alias("high"))


@query("group_by_day", "SELECT date_trunc('day', l_shipdate) AS day_ts, count(*) AS n FROM lineitem GROUP BY ALL")
def _group_by_day(c):
    return c.table("lineitem").groupBy(C.trunc_to("day", "l_shipdate").alias("day_ts")).agg(_rows().alias("n"))


@query("array_agg_ordered",
       "SELECT o_custkey, CAST((n - 1) // 1000 AS BIGINT) AS chunk, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY n) AS orders_in_order "
       "FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) GROUP BY ALL")
def _array_agg_ordered(c):
    arrays = summaries.ordered_arrays(c.table("orders"), "o_custkey", "o_orderdate", "o_orderkey", unit="day")
    text = F.array_join(F.transform("items", lambda k: k.cast("string")), ",")
    return arrays.select("o_custkey", "chunk", text.alias("orders_in_order"))


@query("group_size", "SELECT notes, count(*) AS n FROM silver_missions WHERE notes IS NOT NULL GROUP BY notes")
def _group_size(c):
    return summaries.group_size(c.silver["silver_missions"], "notes", "n")


@query("value_counts", "SELECT l_quantity, count(*) AS n FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY l_quantity")
def _value_counts(c):
    return summaries.value_counts(c.table("lineitem"), "l_quantity", "n")


@query("group_agg_sum", "SELECT date_trunc('hour', recorded_at) AS hour_bucket, "
                        f"{count_if('has_anomaly')} AS anomalies FROM silver_flight_logs GROUP BY ALL")
def _group_agg_sum(c):
    hour = C.trunc_to("hour", "recorded_at").alias("hour_bucket")
    return c.silver["silver_flight_logs"].groupBy(hour).agg(C.count_if(F.col("has_anomaly")).alias("anomalies"))


@query("group_mean", f"SELECT route_category, {favg('avg_speed_kmh', 1)} AS mean_speed FROM silver_routes "
                     "WHERE avg_speed_kmh IS NOT NULL GROUP BY route_category")
def _group_mean(c):
    moving = filters.require(c.silver["silver_routes"], "avg_speed_kmh", "route_category")
    return moving.groupBy("route_category").agg(C.fixed_avg("avg_speed_kmh", 1).alias("mean_speed"))


_PIVOT = {"ACTIVE": "active", "IN_MAINTENANCE": "in_maintenance", "GROUNDED": "grounded"}


@query("status_pivot", "SELECT depot_id, " + ", ".join(
    f"{count_if(f'aircraft_status = {chr(39)}{k}{chr(39)}')} AS {v}" for k, v in _PIVOT.items())
    + " FROM silver_aircraft GROUP BY depot_id")
def _status_pivot(c):
    return summaries.status_counts(c.silver["silver_aircraft"], "depot_id", "aircraft_status", _PIVOT)


@query("pre_aggregate_then_join", "SELECT o_orderkey, o_totalprice, n, qty FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, "
                                  f"{fsum('l_quantity', 0)} AS qty FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey")
def _pre_aggregate_then_join(c):
    lines = c.table("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        _rows().alias("n"), C.fixed_sum("l_quantity", 0).alias("qty"))
    return c.table("orders").join(lines, "o_orderkey", "left").select("o_orderkey", "o_totalprice", "n", "qty")


# --- windows ----------------------------------------------------------------
_W = "WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"


def _events(c):
    return c.table("events").select("event_id", "user_id", "ts")


@query("row_number_partitioned", f"SELECT event_id, user_id, ts, row_number() OVER w AS seq FROM events {_W}")
def _row_number_partitioned(c):
    return windows.number_in_order(_events(c), ["user_id"], "ts", ["event_id"], number="seq")


@query("lag_partitioned", f"SELECT event_id, user_id, ts, lag(ts) OVER w AS prev_ts FROM events {_W}")
def _lag_partitioned(c):
    return windows.number_in_order(_events(c), ["user_id"], "ts", ["event_id"], previous="prev_ts").drop("row_number")


@query("gap_since_previous", f"SELECT event_id, user_id, date_diff('second', lag(ts) OVER w, ts) AS gap_s FROM events {_W}")
def _gap_since_previous(c):
    ordered = windows.number_in_order(_events(c), ["user_id"], "ts", ["event_id"], previous="prev_ts")
    return ordered.select("event_id", "user_id", C.seconds_between("prev_ts", "ts").alias("gap_s"))


@query("row_number_global", "SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS rank FROM orders")
def _row_number_global(c):
    return windows.number_globally(c.table("orders").select("o_orderkey", "o_custkey"), "o_orderkey", width=1000000)


@query("count_over_all", "SELECT s_suppkey, count(*) OVER () AS total FROM supplier")
def _count_over_all(c):
    suppliers = c.table("supplier")
    return suppliers.select("s_suppkey", suppliers.agg(_rows().alias("n")).scalar().alias("total"))


# --- order, limit, sets -----------------------------------------------------
@query("sort_asc", "SELECT report_date, total_orders FROM kpi_delivery_performance ORDER BY report_date")
def _sort_asc(c):
    return c.gold["kpi_delivery_performance"].select("report_date", "total_orders").orderBy("report_date")


@query("top_k", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 10")
def _top_k(c):
    return summaries.top_k(summaries.group_size(c.table("orders"), "o_custkey", "n"), "n", "o_custkey")


@query("top_1", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 1")
def _top_1(c):
    return summaries.top_k(summaries.group_size(c.table("lineitem"), "l_partkey", "n"), "n", "l_partkey", 1)


@query("latest_and_previous", "SELECT day_ts, n, n - lag(n) OVER (ORDER BY day_ts) AS delta FROM (SELECT o_orderdate AS day_ts, "
                              "count(*) AS n FROM orders GROUP BY ALL ORDER BY day_ts DESC LIMIT 2)")
def _latest_and_previous(c):
    from parcelwing.plans.reports import latest_and_previous

    daily = c.table("orders").groupBy(F.col("o_orderdate").alias("day_ts")).agg(_rows().alias("n"))
    return latest_and_previous(daily, "day_ts", ["n"]).select("day_ts", "n", F.col("n_delta").alias("delta"))


@query("bounded_sample", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY (o_orderkey * 7919) % 1000003, o_orderkey LIMIT 1000")
def _bounded_sample(c):
    orders = c.table("orders").select("o_orderkey", "o_totalprice")
    return summaries.bounded_sample(orders, (F.col("o_orderkey") * 7919) % 1000003, "o_orderkey")


@query("histogram_bins", "SELECT 2e0 * CAST(floor(l_quantity / 2e0) AS BIGINT) AS bin_start, 2e0 * (CAST(floor(l_quantity / 2e0) AS BIGINT) + 1) AS bin_end, "
                         "count(*) AS frequency FROM lineitem GROUP BY ALL")
def _histogram_bins(c):
    return summaries.histogram(c.table("lineitem"), "l_quantity")


_SETS = {"orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id", "customer": "c_custkey"}


@query("union_all", " UNION ALL ".join(
    f"SELECT '{t}' AS entity, count(*) AS n, min({k}) AS low, max({k}) AS high FROM {t}" for t, k in _SETS.items()))
def _union_all(c):
    parts = [
        c.table(t).agg(_rows().alias("n"), F.min(k).alias("low"), F.max(k).alias("high")).select(
            F.lit(t).alias("entity"), "n", "low", "high")
        for t, k in _SETS.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("scalar_subquery", "SELECT o_orderkey, o_totalprice - (SELECT max(o_totalprice) FROM orders) AS below_best, "
                          "(SELECT count(*) FROM lineitem) AS all_lines FROM orders")
def _scalar_subquery(c):
    orders = c.table("orders")
    best = orders.agg(F.max("o_totalprice").alias("m")).scalar()
    lines = c.table("lineitem").agg(_rows().alias("n")).scalar()
    return orders.select("o_orderkey", (F.col("o_totalprice") - best).alias("below_best"), lines.alias("all_lines"))


@query("cte", "SELECT c_mktsegment, count(*) AS customers, CAST(sum(n) AS BIGINT) AS orders_n FROM customer JOIN "
              "(SELECT o_custkey, count(*) AS n FROM orders GROUP BY ALL) ON o_custkey = c_custkey GROUP BY c_mktsegment")
def _cte(c):
    per_customer = c.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(_rows().alias("n"))
    segments = c.table("customer").select("c_custkey", "c_mktsegment")
    return segments.join(per_customer, "c_custkey").groupBy("c_mktsegment").agg(
        _rows().alias("customers"), F.sum("n").alias("orders_n"))
