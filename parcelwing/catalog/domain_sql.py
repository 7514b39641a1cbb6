"""The domain tables and layers written as SQL common table expressions.

Only used to check results: the SQL is composed for the engine that verifies
the registered queries. It is formulated on its own, from the integer rules of
the test data and from `rules`, not from the DataFrame code.
"""

from __future__ import annotations

import re

from parcelwing import rules
from parcelwing.sources import adapter

AS_OF = str(adapter.AS_OF)
LOAD_TS = str(adapter.LOAD_TS)


# --- expression builders ----------------------------------------------------
def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rnd(expr: str, digits: int = 0) -> str:
    """Half away from zero on the double."""
    x, scale = f"CAST({expr} AS DOUBLE)", f"1e{digits}"
    return (f"(CASE WHEN {x} < 0 THEN -CAST(floor(-{x} * {scale} + 0.5e0) AS BIGINT) "
            f"ELSE CAST(floor({x} * {scale} + 0.5e0) AS BIGINT) END / {scale})")


def even(expr: str, digits: int = 0) -> str:
    return f"(round_even(CAST({expr} AS DOUBLE) * 1e{digits}, 0) / 1e{digits} + 0e0)"


def tier(expr: str, tiers: rules.Tiers, factor: str | None = None) -> str:
    limit = (lambda b: str(b)) if factor is None else (lambda b: f"{factor} * {b}")
    arms = " ".join(f"WHEN {expr} {tiers.op} {limit(b)} THEN '{label}'" for b, label in tiers.bounds)
    return f"CASE {arms} ELSE '{tiers.default}' END"


def words(values) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"


def word_class(expr: str, classes: dict[str, tuple], default: str) -> str:
    arms = " ".join(f"WHEN {expr} IN {words(ws)} THEN '{name}'" for name, ws in classes.items())
    return f"CASE {arms} ELSE '{default}' END"


def pick(values, index: str) -> str:
    return f"([{', '.join(quoted(v) for v in values)}])[CAST({index} AS BIGINT) + 1]"


def canon(expr: str) -> str:
    return f"upper(trim({expr}))"


def fsum(expr: str, digits: int) -> str:
    return f"(CAST(sum(CAST(round({expr} * 1e{digits}) AS BIGINT)) AS DOUBLE) / 1e{digits})"


def favg(expr: str, digits: int) -> str:
    return f"(CAST(sum(CAST(round({expr} * 1e{digits}) AS BIGINT)) AS DOUBLE) / (count({expr}) * 1e{digits}))"


def count_if(condition: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


def pct(part: str, whole: str, digits: int = 1) -> str:
    return rnd(f"(CAST({part} AS DOUBLE) * 1e2 / nullif({whole}, 0))", digits)


def haversine(a: str, b: str, c: str, d: str) -> str:
    chord = (f"pow(sin((radians({c}) - radians({a})) / 2e0), 2e0) + cos(radians({a})) * cos(radians({c})) "
             f"* pow(sin((radians({d}) - radians({b})) / 2e0), 2e0)")
    return f"({2 * rules.EARTH_RADIUS_KM!r} * asin(sqrt(least(1e0, {chord}))))"


def word_list(text: str) -> str:
    return f"string_split_regex(lower({text}), '[^a-z]+')"


def sentiment(text: str, lexicon: dict[int, tuple] = adapter.TEST_LEXICON) -> str:
    found = {w: f"len(list_filter({word_list(text)}, lambda t: t IN {words(ws)}))" for w, ws in lexicon.items()}
    hits = " + ".join(found.values())
    total = " + ".join(f"{n} * ({w})" for w, n in found.items())
    return f"coalesce({rnd(f'(CAST({total} AS DOUBLE) / nullif(({hits}) * 10, 0))', 4)}, 0e0)"


def label(score: str) -> str:
    pos, neg, neutral = rules.SENTIMENT_LABELS
    b = rules.SENTIMENT_BOUND
    return f"CASE WHEN {score} >= {b}e0 THEN '{pos}' WHEN {score} <= -{b}e0 THEN '{neg}' ELSE '{neutral}' END"


_NS = "(SELECT count(*) FROM supplier)"
_NC = "(SELECT count(*) FROM customer)"


def _depot_lat(d: str) -> str:
    return f"(20e0 + ({d} % 40) * 0.5e0)"


def _depot_lon(d: str) -> str:
    return f"(-120e0 + ({d} % 97) * 0.5e0)"


_STATUS_CLASS = ("CASE WHEN o_orderstatus = 'F' THEN 'COMPLETED' WHEN o_orderstatus = 'O' THEN "
                 "CASE WHEN k % 2 = 0 THEN 'ASSIGNED' ELSE 'IN_FLIGHT' END "
                 "WHEN k % 2 = 0 THEN 'ABORTED' ELSE 'FAILED' END")


def customer_columns(k: str = "c_custkey", phone_suffix: str = "''") -> str:
    return f"""'CUS-' || {k} AS customer_id, '  ' || c_name || ' ' AS name, ' USER' || {k} || '@EXAMPLE.COM ' AS email,
      '+1-(' || (200 + {k} % 800) || ') ' || lpad(CAST({k} % 10000 AS VARCHAR), 4, '0') || {phone_suffix} AS phone,
      ' ' || {k} || ' ' || c_mktsegment || ' Street ' AS address,
      TIMESTAMP '2020-01-01' + to_days(CAST({k} % 1000 AS INTEGER)) AS created_at"""


CTES: dict[str, str] = {}

# --- raw tables -------------------------------------------------------------
CTES["order_base"] = f"""
  SELECT k, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, created_at,
    {_depot_lat('d')} + ((k * 37 % 101) - 50) / 1e3 AS pickup_lat,
    {_depot_lon('d')} + ((k * 41 % 101) - 50) / 1e3 AS pickup_lon,
    {_depot_lat('d')} + ((k * 43 % 161) - 80) / 1e3 AS dropoff_lat,
    {_depot_lon('d')} + ((k * 47 % 161) - 80) / 1e3 AS dropoff_lon,
    CASE WHEN o_orderstatus = 'F' THEN created_at + to_minutes(15 + k * 31 % 106) + to_seconds(k * 17 % 60) END AS delivered_at
  FROM (SELECT o_orderkey AS k, o_orderkey % {_NS} AS d, o_custkey, o_orderstatus, o_orderpriority, o_totalprice,
          o_orderdate + to_minutes(o_orderkey * 7919 % 1440) + to_seconds(o_orderkey % 60) AS created_at FROM orders)"""
CTES["mission_base"] = f"SELECT * FROM order_base WHERE o_totalprice >= {adapter.MISSION_MIN_VALUE}"
CTES["route_base"] = f"SELECT * FROM mission_base WHERE o_totalprice <= {adapter.ROUTE_MAX_VALUE}"
CTES["raw_depots"] = f"""
  SELECT 'DEP-' || s_suppkey AS depot_id, '  ' || s_name || ' ' AS depot_name, {_depot_lat('s_suppkey')} AS lat,
    {_depot_lon('s_suppkey')} AS lon, CAST(5 + s_suppkey % 20 AS INTEGER) AS capacity FROM supplier"""
CTES["raw_delivery_zones"] = f"""
  SELECT 'ZN-' || k AS zone_id, ' ' || p_name || ' zone ' AS zone_name,
    {_depot_lat('d')} + (k % 5 - 2) * 0.03e0 AS center_lat, {_depot_lon('d')} + (k % 7 - 3) * 0.03e0 AS center_lon,
    CAST(3 + k % 6 AS DOUBLE) AS radius_km, {pick((" urban ", "Suburban", "RURAL"), "k % 3")} AS zone_type,
    CASE WHEN k % 7 <> 0 THEN k % 5 <> 0 END AS is_active
  FROM (SELECT p_partkey AS k, p_partkey % {_NS} AS d, p_name FROM part)"""
CTES["raw_no_fly_zones"] = f"""
  SELECT 'NFZ-' || k AS nfz_id, ' no-fly ' || s_name AS zone_name, {_depot_lat('k')} + 0.05e0 AS center_lat,
    {_depot_lon('k')} AS center_lon, (k * 37 % 5000) / 1e3 + 0.5e0 AS radius_km,
    {pick((" permanent", "Temporary "), "k % 2")} AS restriction_type,
    TIMESTAMP '2020-01-01' + to_days(CAST(k % 900 AS INTEGER)) AS effective_from,
    CASE WHEN k % 2 = 1 THEN TIMESTAMP '2023-01-01' + to_days(CAST(k * 7 % 800 AS INTEGER)) END AS effective_to
  FROM (SELECT s_suppkey AS k, s_name FROM supplier)"""
CTES["raw_aircraft"] = f"""
  SELECT 'AC-' || k AS aircraft_id, {pick(adapter.AIRCRAFT_MODELS, "k % 5")} AS model,
    'SN' || lpad(CAST(k AS VARCHAR), 12, '0') AS serial_number,
    CASE WHEN k % 10 < 7 THEN ' active ' WHEN k % 10 < 9 THEN 'IN_MAINTENANCE' ELSE 'Grounded' END AS status,
    'DEP-' || (k % {_NS}) AS depot_id, abs(c_acctbal) / 5e0 AS total_flight_hours,
    CASE WHEN k % 25 <> 0 THEN CAST('{AS_OF}' AS DATE) - CAST(k % 120 AS INTEGER) END AS last_maintenance_date
  FROM (SELECT c_custkey AS k, c_acctbal FROM customer)"""
CTES["raw_customers"] = f"SELECT {customer_columns()} FROM customer"
CTES["raw_orders"] = """
  SELECT 'ORD-' || k AS order_id, 'CUS-' || o_custkey AS customer_id, pickup_lat, pickup_lon, dropoff_lat, dropoff_lon,
    (k * 13 % 150 + 1) / 1e1 AS package_weight_kg,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'critical ' WHEN '2-HIGH' THEN 'EXPRESS' WHEN '4-NOT SPECIFIED' THEN NULL
      ELSE 'Standard' END AS priority,
    CASE o_orderstatus WHEN 'F' THEN ' delivered' WHEN 'O' THEN 'Pending '
      ELSE CASE WHEN k % 2 = 0 THEN 'CANCELLED' ELSE 'failed' END END AS status, created_at, delivered_at
  FROM order_base"""
CTES["raw_missions"] = f"""
  SELECT 'MSN-' || k AS mission_id, 'ORD-' || k AS order_id, 'AC-' || (k % {_NC}) AS aircraft_id,
    ' ' || lower({_STATUS_CLASS}) AS status, created_at - to_minutes(5 + k % 26) AS planned_departure,
    CASE WHEN k % 37 <> 0 THEN created_at + to_minutes(k % 16) END AS actual_departure,
    created_at + to_minutes(20 + k % 41) AS planned_arrival, delivered_at AS actual_arrival,
    CASE WHEN k % 15 <> 0 THEN '  leg ' || (k % 15) || ' ' END AS notes
  FROM mission_base"""
CTES["raw_routes"] = """
  SELECT 'RT-' || k AS route_id, 'MSN-' || k AS mission_id, pickup_lat AS origin_lat, pickup_lon AS origin_lon,
    dropoff_lat AS dest_lat, dropoff_lon AS dest_lon, (k * 13 % 700) / 1e1 AS distance_km,
    CAST(CASE WHEN k % 97 = 0 THEN 0 ELSE 8 + k * 7 % 47 END AS DOUBLE) AS duration_min, k
  FROM route_base"""
CTES["raw_route_segments"] = """
  SELECT route_id || '-' || seq AS segment_id, route_id, CAST(seq AS INTEGER) AS segment_seq,
    origin_lat + (dest_lat - origin_lat) * ((seq - 1) / 4e0) AS start_lat,
    origin_lon + (dest_lon - origin_lon) * ((seq - 1) / 4e0) AS start_lon,
    origin_lat + (dest_lat - origin_lat) * (seq / 4e0) AS end_lat,
    origin_lon + (dest_lon - origin_lon) * (seq / 4e0) AS end_lon,
    distance_km / 4e0 AS distance_km, 30 + (k * 17 + seq * 11) % 900 / 1e1 AS altitude_m
  FROM raw_routes, (SELECT unnest([1, 2, 3, 4]) AS seq)"""
CTES["raw_mission_events"] = """
  SELECT 'EV-' || event_id AS event_id, 'MSN-' || user_id AS mission_id,
    CASE event_type WHEN 'signup' THEN 'TAKEOFF' WHEN 'purchase' THEN ' delivered ' WHEN 'view' THEN 'WAYPOINT'
      WHEN 'click' THEN 'PREFLIGHT_CHECK' ELSE CASE WHEN event_id % 2 = 0 THEN 'SYSTEM_FAILURE' ELSE ' low_battery' END
    END AS event_type, ts AS event_timestamp, ' ' || event_type || ' reported ' AS description,
    20e0 + (event_id % 1000) / 1e2 AS lat, -120e0 + (event_id % 3000) / 1e2 AS lon
  FROM events"""
CTES["raw_flight_logs"] = """
  SELECT 'FL-' || event_id AS flight_log_id, 'AC-' || user_id AS aircraft_id, ts AS recorded_at,
    20e0 + (event_id % 4000) / 1e2 AS lat, -120e0 + (event_id % 5000) / 1e2 AS lon,
    (event_id * 71 % 4200) / 1e1 AS altitude_m, (event_id * 53 % 1300) / 1e1 AS speed_kmh,
    (event_id * 37 % 1010) / 1e1 AS battery_pct, (event_id * 97 % 3600) / 1e1 AS heading_deg
  FROM events"""
CTES["raw_weather_data"] = f"""
  SELECT 'WX-' || event_id AS weather_id, 'WS-' || (user_id % 5) AS station_id, ts AS recorded_at,
    (event_id * 19 % 450) / 1e1 - 5e0 AS temp_c, (event_id * 29 % 600) / 1e1 AS wind_speed_kmh,
    (event_id * 23 % 3600) / 1e1 AS wind_direction_deg, (event_id * 31 % 200) / 1e1 AS visibility_km,
    (event_id * 43 % 250) / 1e1 AS precipitation_mm, {pick(adapter.WEATHER_CONDITIONS, "event_id % 4")} AS conditions
  FROM events"""
CTES["raw_parts_inventory"] = f"""
  SELECT 'PRT-' || p_partkey AS part_id, ' ' || p_name || ' ' AS part_name,
    {pick(adapter.PART_CATEGORIES, "p_partkey % 8")} AS category, p_size AS quantity_on_hand,
    CAST(p_partkey % 40 AS INTEGER) AS reorder_level, p_retailprice AS unit_cost,
    'DEP-' || (p_partkey % {_NS}) AS depot_id
  FROM part"""
CTES["raw_maintenance_logs"] = f"""
  SELECT 'ML-' || k AS log_id, 'AC-' || (k * 3 % {_NC}) AS aircraft_id,
    {pick(adapter.MAINTENANCE_TYPES, "k % 7")} AS maintenance_type,
    {pick(adapter.MAINTENANCE_TEXTS, "k % 5")} AS description, ' Tech ' || (k % 10) AS technician,
    created_at AS started_at, CASE WHEN k % 9 <> 0 THEN created_at + to_minutes(60 + k % 2000) END AS completed_at,
    CASE WHEN k % 9 <> 0 THEN ' completed' ELSE 'in_progress' END AS status
  FROM order_base"""
CTES["raw_parts_used"] = """
  SELECT 'PU-' || l_orderkey || '-' || l_linenumber AS usage_id, 'ML-' || l_orderkey AS log_id,
    'PRT-' || min(l_partkey) AS part_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS INTEGER) AS quantity_used,
    CAST(sum(CAST(round(l_extendedprice * 1e2) AS BIGINT)) AS DOUBLE) / 1e2 AS cost
  FROM lineitem GROUP BY l_orderkey, l_linenumber"""
CTES["raw_delivery_feedback"] = f"""
  SELECT 'FB-' || doc_id AS feedback_id, 'ORD-' || doc_id AS order_id, 'CUS-' || o_custkey AS customer_id,
    CAST(1 + doc_id % 5 AS INTEGER) AS rating, CASE WHEN doc_id % 40 <> 0 THEN text END AS comments,
    {pick(adapter.FEEDBACK_CHANNELS, "doc_id % 5")} AS feedback_channel,
    coalesce(delivered_at, created_at) + to_minutes(30 + doc_id % 1411) AS created_at
  FROM documents JOIN order_base ON k = doc_id"""

# --- silver -----------------------------------------------------------------
_L = f"TIMESTAMP '{LOAD_TS}' AS _dbt_loaded_at"


def _minutes(a: str, b: str) -> str:
    return f"date_diff('minute', {a}, {b})"


CTES["silver_aircraft"] = f"""
  SELECT aircraft_id, trim(model) AS aircraft_model, serial_number, {canon('status')} AS aircraft_status, depot_id,
    {rnd('total_flight_hours', 1)} AS total_flight_hours, last_maintenance_date,
    coalesce(CASE WHEN last_maintenance_date IS NOT NULL THEN
      {tier(f"(CAST('{AS_OF}' AS DATE) - last_maintenance_date)", rules.MAINTENANCE_AGE_TIERS)} END,
      '{rules.MAINTENANCE_UNKNOWN}') AS maintenance_status,
    {tier('total_flight_hours', rules.USAGE_TIERS)} AS usage_tier, {_L}
  FROM raw_aircraft WHERE aircraft_id IS NOT NULL"""
CTES["silver_customers"] = f"""
  SELECT customer_id, trim(name) AS customer_name, lower(trim(email)) AS email,
    regexp_replace(phone, '{rules.PHONE_STRIP}', '', 'g') AS phone_clean, trim(address) AS address, created_at, {_L}
  FROM raw_customers WHERE customer_id IS NOT NULL"""
CTES["silver_delivery_feedback"] = f"""
  SELECT feedback_id, order_id, customer_id, rating, trim(comments) AS comments,
    {canon('feedback_channel')} AS feedback_channel, created_at, score AS sentiment_score,
    {label('score')} AS sentiment_label, {_L}
  FROM (SELECT *, {sentiment('comments')} AS score FROM raw_delivery_feedback
        WHERE feedback_id IS NOT NULL AND comments IS NOT NULL)"""
CTES["silver_delivery_zones"] = f"""
  SELECT zone_id, trim(zone_name) AS zone_name, center_lat, center_lon, {rnd('radius_km', 2)} AS radius_km,
    {canon('zone_type')} AS zone_type, is_active IS DISTINCT FROM FALSE AS is_active, {_L}
  FROM raw_delivery_zones WHERE zone_id IS NOT NULL"""
CTES["silver_depots"] = f"""
  SELECT depot_id, trim(depot_name) AS depot_name, lat, lon, capacity,
    {tier('capacity', rules.DEPOT_SIZES)} AS depot_size, {_L}
  FROM raw_depots WHERE depot_id IS NOT NULL"""
CTES["silver_flight_logs"] = f"""
  SELECT flight_log_id, aircraft_id, recorded_at, lat, lon, {rnd('altitude_m', 1)} AS altitude_m,
    {rnd('speed_kmh', 1)} AS speed_kmh, {rnd('battery_pct', 1)} AS battery_pct, {rnd('heading_deg', 1)} AS heading_deg,
    low AS is_low_battery, fast AS is_overspeed, high AS is_high_altitude, low OR fast OR high AS has_anomaly, {_L}
  FROM (SELECT *, coalesce(battery_pct < {rules.LOW_BATTERY_PCT}, FALSE) AS low,
          coalesce(speed_kmh > {rules.OVERSPEED_KMH}, FALSE) AS fast,
          coalesce(altitude_m > {rules.HIGH_ALTITUDE_M}, FALSE) AS high FROM raw_flight_logs)
  WHERE flight_log_id IS NOT NULL"""
CTES["silver_maintenance_logs"] = f"""
  SELECT log_id, aircraft_id, {canon('maintenance_type')} AS maintenance_type, trim(description) AS description,
    trim(technician) AS technician, started_at, completed_at, {canon('status')} AS maintenance_status,
    {_minutes('started_at', 'completed_at')} AS duration_min,
    {word_class(canon('maintenance_type'), rules.MAINTENANCE_URGENCIES, rules.MAINTENANCE_URGENCY_DEFAULT)} AS urgency_level, {_L}
  FROM raw_maintenance_logs WHERE log_id IS NOT NULL"""
CTES["silver_missions"] = f"""
  SELECT mission_id, order_id, aircraft_id, {canon('status')} AS mission_status, planned_departure, actual_departure,
    planned_arrival, actual_arrival, trim(notes) AS notes,
    {_minutes('actual_departure', 'actual_arrival')} AS actual_duration_min,
    {_minutes('planned_departure', 'planned_arrival')} AS planned_duration_min,
    {_minutes('planned_departure', 'actual_departure')} AS departure_delay_min, {_L}
  FROM raw_missions WHERE mission_id IS NOT NULL"""
CTES["silver_mission_events"] = f"""
  SELECT event_id, mission_id, {canon('event_type')} AS event_type, event_timestamp, trim(description) AS description,
    lat, lon, {word_class(canon('event_type'), rules.EVENT_SEVERITIES, rules.EVENT_SEVERITY_DEFAULT)} AS severity, {_L}
  FROM raw_mission_events WHERE event_id IS NOT NULL"""
CTES["silver_mission_timeline"] = """
  SELECT mission_id, event_type, event_timestamp, severity, description, lat, lon, aircraft_id, order_id,
    mission_status, row_number() OVER w AS event_sequence, lag(event_timestamp) OVER w AS prev_event_timestamp,
    date_diff('second', lag(event_timestamp) OVER w, event_timestamp) AS seconds_since_prev_event
  FROM silver_mission_events e JOIN silver_missions m USING (mission_id)
  WINDOW w AS (PARTITION BY mission_id ORDER BY event_timestamp, event_id)"""
CTES["silver_no_fly_zones"] = f"""
  SELECT nfz_id, trim(zone_name) AS zone_name, center_lat, center_lon, {rnd('radius_km', 2)} AS radius_km,
    {canon('restriction_type')} AS restriction_type, effective_from, effective_to,
    coalesce(effective_to > TIMESTAMP '{AS_OF}', TRUE) AS is_currently_active, {_L}
  FROM raw_no_fly_zones WHERE nfz_id IS NOT NULL"""
CTES["silver_orders"] = f"""
  SELECT order_id, customer_id, pickup_lat, pickup_lon, dropoff_lat, dropoff_lon,
    {rnd('package_weight_kg', 2)} AS package_weight_kg,
    coalesce({canon('priority')}, '{rules.DEFAULT_PRIORITY}') AS priority, {canon('status')} AS order_status,
    created_at, delivered_at, {_minutes('created_at', 'delivered_at')} AS delivery_time_min,
    {rnd(haversine('pickup_lat', 'pickup_lon', 'dropoff_lat', 'dropoff_lon'), 2)} AS straight_line_distance_km, {_L}
  FROM raw_orders WHERE order_id IS NOT NULL"""
CTES["silver_parts_inventory"] = f"""
  SELECT part_id, trim(part_name) AS part_name, {canon('category')} AS category, quantity_on_hand, reorder_level,
    {rnd('unit_cost', 2)} AS unit_cost, depot_id,
    {tier('quantity_on_hand', rules.STOCK_FACTORS, 'reorder_level')} AS stock_status,
    {rnd('quantity_on_hand * unit_cost', 2)} AS inventory_value, {_L}
  FROM raw_parts_inventory WHERE part_id IS NOT NULL"""
CTES["silver_parts_used"] = f"""
  SELECT usage_id, log_id, part_id, quantity_used, {rnd('cost', 2)} AS cost,
    {rnd('(cost / nullif(CAST(quantity_used AS DOUBLE), 0e0))', 2)} AS cost_per_unit, {_L}
  FROM raw_parts_used WHERE usage_id IS NOT NULL"""
CTES["silver_routes"] = f"""
  SELECT route_id, mission_id, origin_lat, origin_lon, dest_lat, dest_lon, {rnd('distance_km', 2)} AS distance_km,
    {rnd('duration_min', 1)} AS duration_min,
    CASE WHEN distance_km > 0 AND duration_min > 0 THEN {rnd('(distance_km / (duration_min / 6e1))', 1)} END AS avg_speed_kmh,
    {tier('distance_km', rules.ROUTE_CATEGORIES)} AS route_category, {_L}
  FROM raw_routes WHERE route_id IS NOT NULL"""
CTES["silver_route_segments"] = f"""
  SELECT segment_id, route_id, segment_seq, start_lat, start_lon, end_lat, end_lon, {rnd('distance_km', 3)} AS distance_km,
    {rnd('altitude_m', 1)} AS altitude_m,
    {rnd(haversine('start_lat', 'start_lon', 'end_lat', 'end_lon'), 3)} AS straight_line_km, {_L}
  FROM raw_route_segments WHERE segment_id IS NOT NULL"""
_SEVERITY = " ".join(
    f"WHEN wind_speed_kmh > {w} OR visibility_km < {s} OR precipitation_mm > {r} THEN '{n}'"
    for n, (w, s, r) in rules.WEATHER_LIMITS.items())
_STORM, _BLIND, _ = rules.WEATHER_LIMITS["SEVERE"]
CTES["silver_weather_data"] = f"""
  SELECT weather_id, station_id, recorded_at, {rnd('temp_c', 1)} AS temp_c, {rnd('wind_speed_kmh', 1)} AS wind_speed_kmh,
    {rnd('wind_direction_deg', 0)} AS wind_direction_deg, {rnd('visibility_km', 1)} AS visibility_km,
    {rnd('precipitation_mm', 1)} AS precipitation_mm, {canon('conditions')} AS conditions,
    CASE {_SEVERITY} ELSE '{rules.WEATHER_DEFAULT}' END AS weather_severity,
    NOT coalesce(wind_speed_kmh > {_STORM} OR visibility_km < {_BLIND}, FALSE) AS is_flyable, {_L}
  FROM raw_weather_data WHERE weather_id IS NOT NULL"""

# --- gold -------------------------------------------------------------------
CTES["dim_aircraft"] = f"""
  SELECT aircraft_id, aircraft_model, serial_number, aircraft_status, depot_id, depot_name, total_flight_hours,
    last_maintenance_date, maintenance_status, usage_tier, coalesce(n, 0) AS total_missions,
    coalesce(done, 0) AS completed_missions, coalesce(serviced, 0) AS total_maintenance_events, last_mission_at
  FROM silver_aircraft LEFT JOIN (SELECT depot_id, depot_name FROM silver_depots) USING (depot_id)
  LEFT JOIN (SELECT aircraft_id, count(*) AS n, {count_if("mission_status = 'COMPLETED'")} AS done,
      max(actual_departure) AS last_mission_at FROM silver_missions GROUP BY ALL) USING (aircraft_id)
  LEFT JOIN (SELECT aircraft_id, count(*) AS serviced FROM silver_maintenance_logs GROUP BY ALL) USING (aircraft_id)"""
CTES["dim_customers"] = f"""
  SELECT customer_id, customer_name, email, phone_clean AS phone, address, created_at AS customer_since,
    coalesce(n, 0) AS total_orders, coalesce(done, 0) AS delivered_orders, coalesce(stars, 0e0) AS avg_rating,
    coalesce(mood, 0e0) AS avg_sentiment, last_order_at, coalesce(mins, 0e0) AS avg_delivery_time_min
  FROM silver_customers
  LEFT JOIN (SELECT customer_id, count(*) AS n, {count_if("order_status = 'DELIVERED'")} AS done,
      max(created_at) AS last_order_at, {favg('delivery_time_min', 0)} AS mins
    FROM silver_orders GROUP BY ALL) USING (customer_id)
  LEFT JOIN (SELECT customer_id, {favg('rating', 0)} AS stars, {favg('sentiment_score', 4)} AS mood
    FROM silver_delivery_feedback GROUP BY ALL) USING (customer_id)"""
CTES["dim_delivery_zones"] = "SELECT * EXCLUDE (_dbt_loaded_at) FROM silver_delivery_zones"
CTES["dim_depots"] = f"""
  SELECT depot_id, depot_name, lat, lon, capacity, depot_size, coalesce(n, 0) AS aircraft_count,
    coalesce(up, 0) AS active_aircraft, coalesce(worth, 0e0) AS total_inventory_value,
    coalesce(short, 0) AS parts_needing_reorder
  FROM silver_depots
  LEFT JOIN (SELECT depot_id, count(*) AS n, {count_if("aircraft_status = 'ACTIVE'")} AS up
    FROM silver_aircraft GROUP BY ALL) USING (depot_id)
  LEFT JOIN (SELECT depot_id, {fsum('inventory_value', 2)} AS worth,
    {count_if("stock_status = 'REORDER_NEEDED'")} AS short FROM silver_parts_inventory GROUP BY ALL) USING (depot_id)"""
CTES["fct_deliveries"] = """
  SELECT o.order_id, o.customer_id, m.mission_id, m.aircraft_id, o.priority, o.order_status, m.mission_status,
    o.package_weight_kg, o.straight_line_distance_km, r.distance_km AS route_distance_km,
    r.duration_min AS planned_duration_min, r.avg_speed_kmh AS planned_avg_speed, r.route_category,
    o.created_at AS order_created_at, m.actual_departure, m.actual_arrival, o.delivered_at, o.delivery_time_min,
    m.actual_duration_min AS flight_duration_min, m.departure_delay_min, f.rating AS feedback_rating,
    f.sentiment_score, f.sentiment_label
  FROM silver_orders o LEFT JOIN silver_missions m USING (order_id)
    LEFT JOIN silver_routes r ON r.mission_id = m.mission_id
    LEFT JOIN silver_delivery_feedback f ON f.order_id = o.order_id"""
CTES["fct_flight_telemetry"] = f"""
  SELECT aircraft_id, date_trunc('hour', recorded_at) AS hour_bucket, count(*) AS telemetry_points,
    {favg('altitude_m', 1)} AS avg_altitude_m, max(altitude_m) AS max_altitude_m,
    {favg('speed_kmh', 1)} AS avg_speed_kmh, max(speed_kmh) AS max_speed_kmh, min(battery_pct) AS min_battery_pct,
    {favg('battery_pct', 1)} AS avg_battery_pct, {count_if('has_anomaly')} AS anomaly_count,
    {count_if('is_low_battery')} AS low_battery_count, {count_if('is_overspeed')} AS overspeed_count
  FROM silver_flight_logs GROUP BY aircraft_id, hour_bucket"""
CTES["fct_maintenance"] = f"""
  SELECT * EXCLUDE (_dbt_loaded_at, n, q, c), coalesce(n, 0) AS parts_used_count,
    coalesce(q, 0) AS total_parts_quantity, coalesce(c, 0e0) AS total_parts_cost
  FROM silver_maintenance_logs LEFT JOIN (SELECT log_id, count(*) AS n, CAST(sum(quantity_used) AS BIGINT) AS q,
    {fsum('cost', 2)} AS c FROM silver_parts_used GROUP BY ALL) USING (log_id)"""
CTES["kpi_delivery_performance"] = f"""
  SELECT date_trunc('day', order_created_at) AS report_date, count(*) AS total_orders,
    {count_if("order_status = 'DELIVERED'")} AS delivered_orders,
    {count_if("order_status = 'CANCELLED'")} AS cancelled_orders,
    {pct(count_if("order_status = 'DELIVERED'"), 'count(*)')} AS delivery_success_rate_pct,
    {favg('delivery_time_min', 0)} AS avg_delivery_time_min,
    CAST(median(delivery_time_min) AS DOUBLE) AS median_delivery_time_min,
    {favg('route_distance_km', 2)} AS avg_route_distance_km, {favg('feedback_rating', 0)} AS avg_customer_rating,
    {favg('sentiment_score', 4)} AS avg_sentiment_score, count(DISTINCT aircraft_id) AS active_aircraft,
    {favg('departure_delay_min', 0)} AS avg_departure_delay_min
  FROM fct_deliveries GROUP BY report_date"""


def compose(body: str, extra: dict[str, str] | None = None) -> str:
    """A full statement: the body preceded by the expressions it needs."""
    known = {**CTES, **(extra or {})}
    names = re.compile(r"\b(" + "|".join(sorted(known, key=len, reverse=True)) + r")\b")
    ordered: list[str] = []

    def visit(text: str, inside: str | None = None) -> None:
        for name in dict.fromkeys(names.findall(text)):
            if name != inside and name not in ordered:
                visit(known[name], name)
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    if not ordered:
        return body
    heads = ",\n".join(f"{name} AS ({known[name]})" for name in ordered)
    own = body.strip()
    return f"WITH {heads},\n{own[5:]}" if own.startswith("WITH ") else f"WITH {heads}\n{body}"
