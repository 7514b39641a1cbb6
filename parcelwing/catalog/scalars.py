"""Queries: scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelwing import rules
from parcelwing.catalog.domain_sql import even, haversine, rnd, tier, words
from parcelwing.catalog.registry import query
from parcelwing.functions import columns as C


def scalar(name: str, table: str, key: str, sql: str | None, build):
    """A projection of `table`: its key and the columns that `build` returns."""
    layer, _, short = table.partition("_")

    def run(c):
        df = {"raw": lambda: c.raw[short], "silver": lambda: c.silver[table]}.get(layer, lambda: c.table(table))()
        return df.select(key, *[column.alias(alias) for alias, column in build().items()])

    query(name, f"SELECT {key}, {sql} FROM {table}" if sql else None)(run)


# --- strings ----------------------------------------------------------------
scalar("str_trim", "raw_customers", "customer_id",
       "trim(name) AS name, trim(chr(9) || address) AS kept_tab",
       lambda: {"name": F.trim("name"), "kept_tab": F.trim(F.concat(F.lit("\t"), "address"))})
scalar("str_upper", "raw_orders", "order_id", "upper(trim(status)) AS status, upper(priority) AS priority",
       lambda: {"status": C.canon("status"), "priority": F.upper("priority")})
scalar("str_lower", "raw_customers", "customer_id", "lower(trim(email)) AS email",
       lambda: {"email": F.lower(F.trim("email"))})
scalar("regexp_clean", "raw_customers", "customer_id",
       f"regexp_replace(phone, '{rules.PHONE_STRIP}', '', 'g') AS phone_clean",
       lambda: {"phone_clean": F.regexp_replace("phone", rules.PHONE_STRIP, "")})
scalar("str_concat", "raw_orders", "order_id", "customer_id || '/' || trim(priority) AS joined",
       lambda: {"joined": F.concat("customer_id", F.lit("/"), F.trim("priority"))})
scalar("str_lpad", "orders", "o_orderkey", "'OR-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS padded",
       lambda: {"padded": F.concat(F.lit("OR-"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))})
scalar("cast", "orders", "o_orderkey",
       "CAST(o_orderkey AS VARCHAR) AS as_text, CAST(o_custkey AS DOUBLE) AS as_double, "
       "CAST(o_orderkey % 1000 AS INTEGER) AS as_int, TRY_CAST(left(o_orderpriority, 1) AS INTEGER) AS first_digit, "
       "TRY_CAST(o_orderstatus AS INTEGER) AS not_a_number, CAST('2024-02-29 12:30:00' AS TIMESTAMP) AS as_ts",
       lambda: {"as_text": F.col("o_orderkey").cast("string"), "as_double": F.col("o_custkey").cast("double"),
                "as_int": (F.col("o_orderkey") % 1000).cast("int"),
                "first_digit": F.left("o_orderpriority", F.lit(1)).try_cast("int"),
                "not_a_number": F.col("o_orderstatus").try_cast("int"),
                "as_ts": C.moment("2024-02-29 12:30:00")})
scalar("case_when", "raw_aircraft", "aircraft_id",
       f"{tier('total_flight_hours', rules.USAGE_TIERS)} AS usage_tier, "
       "CASE trim(model) WHEN 'Kestrel' THEN 1 WHEN 'Heron' THEN 2 ELSE 0 END AS model_code",
       lambda: {"usage_tier": C.tier("total_flight_hours", rules.USAGE_TIERS),
                "model_code": F.when(F.trim("model") == "Kestrel", 1).when(F.trim("model") == "Heron", 2).otherwise(0)})
_CRITICAL = rules.EVENT_SEVERITIES["CRITICAL"]
scalar("in_list", "raw_mission_events", "event_id", f"upper(trim(event_type)) IN {words(_CRITICAL)} AS is_critical",
       lambda: {"is_critical": C.canon("event_type").isin(*_CRITICAL)})
scalar("not_in_list", "raw_orders", "order_id",
       f"upper(trim(priority)) NOT IN {words(rules.ACCEPTED_PRIORITIES)} AS is_unknown, "
       "upper(trim(priority)) NOT IN ('EXPRESS', 'CRITICAL') AS is_ordinary",
       lambda: {"is_unknown": ~C.canon("priority").isin(*rules.ACCEPTED_PRIORITIES),
                "is_ordinary": ~C.canon("priority").isin("EXPRESS", "CRITICAL")})
scalar("coalesce", "raw_orders", "order_id",
       "coalesce(upper(trim(priority)), 'STANDARD') AS priority, coalesce(delivered_at, created_at) AS last_seen",
       lambda: {"priority": F.coalesce(C.canon("priority"), F.lit(rules.DEFAULT_PRIORITY)),
                "last_seen": F.coalesce("delivered_at", "created_at")})
scalar("nullif_div", "raw_parts_inventory", "part_id",
       "unit_cost / nullif(CAST(reorder_level AS DOUBLE), 0e0) AS cost_per_level",
       lambda: {"cost_per_level": C.safe_divide("unit_cost", "reorder_level")})
scalar("is_null", "raw_orders", "order_id", "delivered_at IS NULL AS is_open, priority IS NOT NULL AS has_priority",
       lambda: {"is_open": F.col("delivered_at").isNull(), "has_priority": F.col("priority").isNotNull()})
scalar("bool_or_and", "raw_delivery_zones", "zone_id",
       "is_active AND radius_km > 5 AS both, is_active OR radius_km > 5 AS either, NOT is_active AS neither",
       lambda: {"both": F.col("is_active") & (F.col("radius_km") > 5),
                "either": F.col("is_active") | (F.col("radius_km") > 5), "neither": ~F.col("is_active")})

# --- numbers ----------------------------------------------------------------
scalar("round_n", "lineitem", "l_orderkey",
       f"{rnd('l_extendedprice', 1)} AS price_1, {rnd('(l_discount - 0.05e0)', 1)} AS signed_1, {rnd('l_quantity / 4e0')} AS quarter",
       lambda: {"price_1": C.round_half_up("l_extendedprice", 1),
                "signed_1": C.round_half_up(F.col("l_discount") - 0.05, 1),
                "quarter": C.round_half_up(F.col("l_quantity") / 4.0)})
scalar("bankers_round", "lineitem", "l_orderkey",
       f"{even('l_quantity / 2e0')} AS half, {even('l_extendedprice', 1)} AS price_1",
       lambda: {"half": C.round_half_even(F.col("l_quantity") / 2.0), "price_1": C.round_half_even("l_extendedprice", 1)})
scalar("arith", "lineitem", "l_orderkey",
       "l_extendedprice * (1e0 - l_discount) + l_tax AS net, l_quantity - 1 AS less, l_partkey / 7e0 AS ratio",
       lambda: {"net": F.col("l_extendedprice") * (1.0 - F.col("l_discount")) + F.col("l_tax"),
                "less": F.col("l_quantity") - 1, "ratio": F.col("l_partkey") / 7.0})
scalar("modulo", "orders", "o_orderkey", "o_orderkey % 15 AS slot, (o_orderkey * 31) % 106 AS spread",
       lambda: {"slot": F.col("o_orderkey") % 15, "spread": F.pmod(F.col("o_orderkey") * 31, F.lit(106))})
scalar("floor_", "orders", "o_orderkey", "CAST(floor(o_totalprice / 1e3) AS BIGINT) AS thousands",
       lambda: {"thousands": F.floor(F.col("o_totalprice") / 1000.0)})
scalar("sqrt_power", "raw_orders", "order_id",
       rnd("sqrt(pow((dropoff_lat - pickup_lat) * 111e0, 2e0) + pow((dropoff_lon - pickup_lon) * 85e0, 2e0))", 6) + " AS flat_km",
       lambda: {"flat_km": C.round_half_up(C.planar_km("pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon"), 6)})
scalar("sin_hour", "events", "event_id", rnd("sin(2e0 * pi() * hour(ts) / 24e0)", 6) + " AS cycle",
       lambda: {"cycle": C.round_half_up(F.sin(F.lit(2.0) * F.pi() * F.hour("ts") / 24.0), 6)})
scalar("greatest_", "raw_missions", "mission_id",
       "CASE WHEN actual_arrival IS NOT NULL AND planned_arrival IS NOT NULL "
       "THEN greatest(actual_arrival, planned_arrival) END AS later_arrival",
       lambda: {"later_arrival": C.greatest_or_null("actual_arrival", "planned_arrival")})
scalar("haversine_km", "raw_orders", "order_id",
       rnd(haversine("pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon"), 6) + " AS km",
       lambda: {"km": C.round_half_up(C.haversine_km("pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon"), 6)})

# --- time -------------------------------------------------------------------
scalar("date_diff_day", "raw_aircraft", "aircraft_id",
       "CAST(DATE '2024-01-31' - last_maintenance_date AS BIGINT) AS days",
       lambda: {"days": C.days_between("last_maintenance_date", F.to_date(F.lit("2024-01-31"))).cast("bigint")})
scalar("date_diff_minute", "raw_orders", "order_id", "date_diff('minute', created_at, delivered_at) AS minutes",
       lambda: {"minutes": C.minutes_between("created_at", "delivered_at")})
scalar("date_diff_second", "raw_missions", "mission_id",
       "date_diff('second', planned_arrival, actual_arrival) AS seconds",
       lambda: {"seconds": C.seconds_between("planned_arrival", "actual_arrival")})
scalar("date_trunc_", "events", "event_id", "date_trunc('hour', ts) AS hour_ts, date_trunc('day', ts) AS day_ts",
       lambda: {"hour_ts": C.trunc_to("hour", "ts"), "day_ts": C.trunc_to("day", "ts")})
scalar("date_add_unit", "orders", "o_orderkey",
       "o_orderdate + to_days(CAST(o_orderkey % 9 AS INTEGER)) AS d, o_orderdate + to_hours(o_orderkey % 25) AS h, "
       "o_orderdate + to_minutes(-(o_orderkey % 61)) AS m, o_orderdate + to_seconds(o_orderkey % 3601) AS s",
       lambda: {"d": C.plus("o_orderdate", day=F.col("o_orderkey") % 9),
                "h": C.plus("o_orderdate", hour=F.col("o_orderkey") % 25),
                "m": C.plus("o_orderdate", minute=-(F.col("o_orderkey") % 61)),
                "s": C.plus("o_orderdate", second=F.col("o_orderkey") % 3601)})

# --- nested values ----------------------------------------------------------
scalar("json_parse", "events", "event_id", "CAST(props ->> '$.k' AS INTEGER) AS k",
       lambda: {"k": F.variant_get(F.parse_json("props"), "$.k", "int")})
scalar("array_literal_index", "orders", "o_orderkey",
       "(['APP', 'EMAIL', 'SMS', 'WEB', 'PHONE'])[o_orderkey % 7 + 1] AS channel",
       lambda: {"channel": C.element_or_null(F.array(*[F.lit(x) for x in ("APP", "EMAIL", "SMS", "WEB", "PHONE")]),
                                             (F.col("o_orderkey") % 7).cast("int"))})

# --- values that differ by engine or run: their properties -------------------
def _hash_properties() -> dict:
    hashed, again = C.positive_hash("o_orderkey"), C.positive_hash(F.col("o_orderkey").cast("int").cast("bigint"))
    return {"not_negative": hashed >= 0, "in_slots": (hashed % 15).between(0, 14), "repeatable": hashed == again}


scalar("abs_hash", "orders", "o_orderkey", "TRUE AS not_negative, TRUE AS in_slots, TRUE AS repeatable", _hash_properties)
scalar("uuid_", "orders", "o_orderkey", "TRUE AS is_uuid, TRUE AS is_version_4",
       lambda: {"is_uuid": F.uuid().rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"),
                "is_version_4": F.substring(F.uuid(), 15, 1) == "4"})
scalar("now_", "orders", "o_orderkey", "TRUE AS is_later, TRUE AS same_day",
       lambda: {"is_later": F.current_timestamp().cast("timestamp_ntz") > F.col("o_orderdate").cast("timestamp_ntz"),
                "same_day": F.to_date(F.current_timestamp()) == F.current_date()})
