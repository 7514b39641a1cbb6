"""Queries: row-shaping operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelwing import rules
from parcelwing.catalog.domain_sql import rnd
from parcelwing.catalog.registry import query
from parcelwing.functions import columns as C
from parcelwing.operators import shaping


@query("assign_round_robin", "SELECT o_orderkey, s_suppkey, s_name FROM orders JOIN "
                             "(SELECT *, row_number() OVER (ORDER BY s_suppkey) - 1 AS slot FROM supplier) "
                             "ON slot = o_orderkey % (SELECT count(*) FROM supplier)")
def _assign_round_robin(c):
    members = c.table("supplier")
    orders = c.table("orders").select("o_orderkey")
    assigned = shaping.assign_round_robin(orders, "o_orderkey", members, "s_suppkey", ["s_suppkey", "s_name"])
    return assigned.select("o_orderkey", "s_suppkey", "s_name")


@query("interpolate_path", "SELECT order_id, CAST(p AS INTEGER) AS point_seq, pickup_lat + (dropoff_lat - pickup_lat) * (p / 1e1) AS lat, "
                           "pickup_lon + (dropoff_lon - pickup_lon) * (p / 1e1) AS lon FROM raw_orders, (SELECT unnest(range(10)) AS p)")
def _interpolate_path(c):
    path = shaping.interpolate_path(c.raw["orders"], 10, ("pickup_lat", "dropoff_lat"), ("pickup_lon", "dropoff_lon"))
    return path.select("order_id", "point_seq", "lat", "lon")


@query("split_route_segments", "SELECT route_id, segment_seq, start_lat, start_lon, end_lat, end_lon, distance_km FROM raw_route_segments")
def _split_route_segments(c):
    return shaping.split_route_segments(c.raw["routes"]).select(
        "route_id", "segment_seq", "start_lat", "start_lon", "end_lat", "end_lon", "distance_km")


_STEPS = ", ".join(f"({n}, '{kind}', {share!r}::DOUBLE)" for n, kind, share in rules.MILESTONES)


@query("expand_event_schedule", f"""
  SELECT mission_id, seq AS event_seq, kind AS event_type,
    actual_departure + to_seconds(CAST({rnd('(span * share)')} AS BIGINT)) AS event_timestamp
  FROM (SELECT *, date_diff('second', actual_departure, coalesce(actual_arrival, actual_departure + to_minutes({rules.OPEN_MISSION_MINUTES}))) AS span
        FROM raw_missions WHERE actual_departure IS NOT NULL), (VALUES {_STEPS}) AS t(seq, kind, share)""")
def _expand_event_schedule(c):
    return shaping.expand_event_schedule(c.raw["missions"]).select("mission_id", "event_seq", "event_type", "event_timestamp")


@query("hour_grid", "SELECT user_id, unnest(generate_series(date_trunc('hour', first_ts), date_trunc('hour', last_ts), INTERVAL 1 HOUR)) AS hour_ts "
                    "FROM (SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY user_id)")
def _hour_grid(c):
    spans = c.table("events").groupBy("user_id").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return shaping.hour_grid(spans, "first_ts", "last_ts").select("user_id", "hour_ts")


@query("waypoints_json", "SELECT route_id, CAST(i AS INTEGER) AS waypoint_index, origin_lat + (dest_lat - origin_lat) * f AS lat, "
                         "origin_lon + (dest_lon - origin_lon) * f AS lon FROM raw_routes, (VALUES (0, 0.25e0), (1, 0.5e0), (2, 0.75e0)) AS w(i, f)")
def _waypoints_json(c):
    return shaping.waypoint_rows(c.raw["routes"]).select("route_id", "waypoint_index", "lat", "lon")


@query("planar_distance", "SELECT order_id, " + rnd(
    "sqrt(pow((dropoff_lat - pickup_lat) * 111e0, 2e0) + pow((dropoff_lon - pickup_lon) * 85e0, 2e0))", 2) + " AS planar_km FROM raw_orders")
def _planar_distance(c):
    km = C.planar_km("pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon")
    return c.raw["orders"].select("order_id", C.round_half_up(km, 2).alias("planar_km"))


@query("status_remap", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'ASSIGNED' "
                       "ELSE 'IN_FLIGHT' END ELSE 'ABORTED' END AS mission_status FROM orders")
def _status_remap(c):
    status = F.col("o_orderstatus")
    order_status = F.when(status == "F", "DELIVERED").when(status == "O", "PENDING").otherwise("CANCELLED")
    remapped = shaping.mission_status(order_status, F.col("o_orderkey") % 2)
    return c.table("orders").select("o_orderkey", remapped.alias("mission_status"))
