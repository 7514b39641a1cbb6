"""Silver layer: cleaned and classified entities.

Each model takes a mapping of bronze (or silver) tables and the reference time
`as_of`, and returns a lazy DataFrame.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwing import rules
from parcelwing.functions import columns as C
from parcelwing.functions import text as T
from parcelwing.operators.windows import number_in_order

Inputs = Mapping[str, DataFrame]
LOADED = "_dbt_loaded_at"


def _keyed(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def _trimmed(name: str, out: str | None = None) -> Column:
    return F.trim(name).alias(out or name)


def _rounded(**digits: int) -> list[Column]:
    return [C.round_half_up(name, n).alias(name) for name, n in digits.items()]


def aircraft(bronze: Inputs, as_of: dt.datetime) -> DataFrame:
    age = C.days_between("last_maintenance_date", F.lit(as_of.date()))
    serviced = F.col("last_maintenance_date").isNotNull()
    return _keyed(bronze["aircraft"], "aircraft_id").select(
        "aircraft_id",
        _trimmed("model", "aircraft_model"),
        "serial_number",
        C.canon("status").alias("aircraft_status"),
        "depot_id",
        *_rounded(total_flight_hours=1),
        "last_maintenance_date",
        F.when(serviced, C.tier(age, rules.MAINTENANCE_AGE_TIERS))
        .otherwise(rules.MAINTENANCE_UNKNOWN).alias("maintenance_status"),
        C.tier("total_flight_hours", rules.USAGE_TIERS).alias("usage_tier"),
        LOADED,
    )


def customers(bronze: Inputs, as_of: dt.datetime) -> DataFrame:
    return _keyed(bronze["customers"], "customer_id").select(
        "customer_id",
        _trimmed("name", "customer_name"),
        F.lower(F.trim("email")).alias("email"),
        F.regexp_replace("phone", rules.PHONE_STRIP, "").alias("phone_clean"),
        _trimmed("address"),
        "created_at",
        LOADED,
    )


def delivery_feedback(bronze: Inputs, as_of: dt.datetime, lexicon: T.Lexicon = rules.SENTIMENT_LEXICON) -> DataFrame:
    commented = _keyed(bronze["delivery_feedback"], "feedback_id").filter(F.col("comments").isNotNull())
    scored = T.with_sentiment(commented, "comments", lexicon)
    return scored.select(
        "feedback_id", "order_id", "customer_id", "rating",
        _trimmed("comments"),
        C.canon("feedback_channel").alias("feedback_channel"),
        "created_at",
        "sentiment_score",
        T.sentiment_label("sentiment_score").alias("sentiment_label"),
        LOADED,
    )


def delivery_zones(bronze: Inputs, as_of: dt.datetime) -> DataFrame:
    return _keyed(bronze["delivery_zones"], "zone_id").select(
        "zone_id", _trimmed("zone_name"), "center_lat", "center_lon",
        *_rounded(radius_km=2),
        C.canon("zone_type").alias("zone_type"),
        F.coalesce("is_active", F.lit(True)).alias("is_active"),
        LOADED,
    )


def depots(bronze: Inputs, as_of: dt.datetime) -> DataFrame:
    return _keyed(bronze["depots"], "depot_id").select(
        "depot_id", _trimmed("depot_name"), "lat", "lon", "capacity",
        C.tier("capacity", rules.DEPOT_SIZES).alias("depot_size"),
        LOADED,
    )


def flight_logs(bronze: Inputs, as_of: dt.datetime) -> DataFrame:
    alarms = {
        "is_low_battery": F.col("battery_pct") < rules.LOW_BATTERY_PCT,
        "is_overspeed": F.col("speed_kmh") > rules.OVERSPEED_KMH,
        "is_high_altitude": F.col("altitude_m") > rules.HIGH_ALTITUDE_M,
    }
    flags = {name: C.flag(raised) for name, raised in alarms.items()}
    anomaly = flags["is_low_battery"] | flags["is_overspeed"] | flags["is_high_altitude"]
    return _keyed(bronze["flight_logs"], "flight_log_id").select(
        "flight_log_id", "aircraft_id", "recorded_at", "lat", "lon",
        *_rounded(altitude_m=1, speed_kmh=1, battery_pct=1, heading_deg=1),
        *[raised.alias(name) for name, raised in flags.items()],
        anomaly.alias("has_anomaly"),
        LOADED,
    )


def maintenance_logs(bronze: Inputs, as_of: dt.datetime) -> DataFrame:
    kind = C.canon("maintenance_type")
    return _keyed(bronze["maintenance_logs"], "log_id").select(
        "log_id", "aircraft_id",
        kind.alias("maintenance_type"),
        _trimmed("description"), _trimmed("technician"),
        "started_at", "completed_at",
        C.canon("status").alias("maintenance_status"),
        C.minutes_between("started_at", "completed_at").alias("duration_min"),
        C.word_class(kind, rules.MAINTENANCE_URGENCIES, rules.MAINTENANCE_URGENCY_DEFAULT).alias("urgency_level"),
        LOADED,
    )


def missions(bronze: Inputs, as_of: dt.datetime) -> DataFrame:
    return _keyed(bronze["missions"], "mission_id").select(
        "mission_id", "order_id", "aircraft_id",
        C.canon("status").alias("mission_status"),
        "planned_departure", "actual_departure", "planned_arrival", "actual_arrival",
        _trimmed("notes"),
        C.minutes_between("actual_departure", "actual_arrival").alias("actual_duration_min"),
        C.minutes_between("planned_departure", "planned_arrival").alias("planned_duration_min"),
        C.minutes_between("planned_departure", "actual_departure").alias("departure_delay_min"),
        LOADED,
    )


def mission_events(bronze: Inputs, as_of: dt.datetime) -> DataFrame:
    kind = C.canon("event_type")
    return _keyed(bronze["mission_events"], "event_id").select(
        "event_id", "mission_id",
        kind.alias("event_type"),
        "event_timestamp", _trimmed("description"), "lat", "lon",
        C.word_class(kind, rules.EVENT_SEVERITIES, rules.EVENT_SEVERITY_DEFAULT).alias("severity"),
        LOADED,
    )


def mission_timeline(silver: Inputs, as_of: dt.datetime) -> DataFrame:
    """Events in order per mission with the gap to the one before.

    Equal timestamps are ordered by event id. The mission's own columns travel
    with the per-bucket summary, so events are shuffled once, by mission and
    minute, and a mission with very many events is spread over its minutes.
    """
    mission = silver["silver_missions"].select("mission_id", "aircraft_id", "order_id", "mission_status")
    events = silver["silver_mission_events"].drop(LOADED).filter(F.col("mission_id").isNotNull())
    ordered = number_in_order(
        events, ["mission_id"], "event_timestamp", ["event_id"],
        number="event_sequence", previous="prev_event_timestamp", unit="minute", attributes=mission,
    )
    return ordered.select(
        "mission_id", "event_type", "event_timestamp", "severity", "description", "lat", "lon",
        "aircraft_id", "order_id", "mission_status", "event_sequence", "prev_event_timestamp",
        C.seconds_between("prev_event_timestamp", "event_timestamp").alias("seconds_since_prev_event"),
    )


def no_fly_zones(bronze: Inputs, as_of: dt.datetime) -> DataFrame:
    """A zone is active until its end; the start is deliberately not looked at."""
    open_end = F.col("effective_to").isNull()
    return _keyed(bronze["no_fly_zones"], "nfz_id").select(
        "nfz_id", _trimmed("zone_name"), "center_lat", "center_lon",
        *_rounded(radius_km=2),
        C.canon("restriction_type").alias("restriction_type"),
        "effective_from", "effective_to",
        (open_end | C.flag(F.col("effective_to") > C.moment(as_of))).alias("is_currently_active"),
        LOADED,
    )


def orders(bronze: Inputs, as_of: dt.datetime) -> DataFrame:
    distance = C.haversine_km("pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon")
    return _keyed(bronze["orders"], "order_id").select(
        "order_id", "customer_id", "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon",
        *_rounded(package_weight_kg=2),
        F.coalesce(C.canon("priority"), F.lit(rules.DEFAULT_PRIORITY)).alias("priority"),
        C.canon("status").alias("order_status"),
        "created_at", "delivered_at",
        C.minutes_between("created_at", "delivered_at").alias("delivery_time_min"),
        C.round_half_up(distance, 2).alias("straight_line_distance_km"),
        LOADED,
    )


def parts_inventory(bronze: Inputs, as_of: dt.datetime) -> DataFrame:
    return _keyed(bronze["parts_inventory"], "part_id").select(
        "part_id", _trimmed("part_name"),
        C.canon("category").alias("category"),
        "quantity_on_hand", "reorder_level",
        *_rounded(unit_cost=2),
        "depot_id",
        C.tier("quantity_on_hand", rules.STOCK_FACTORS, factor="reorder_level").alias("stock_status"),
        C.round_half_up(F.col("quantity_on_hand") * F.col("unit_cost"), 2).alias("inventory_value"),
        LOADED,
    )


def parts_used(bronze: Inputs, as_of: dt.datetime) -> DataFrame:
    per_unit = C.safe_divide("cost", "quantity_used")
    return _keyed(bronze["parts_used"], "usage_id").select(
        "usage_id", "log_id", "part_id", "quantity_used",
        *_rounded(cost=2),
        C.round_half_up(per_unit, 2).alias("cost_per_unit"),
        LOADED,
    )


def routes(bronze: Inputs, as_of: dt.datetime) -> DataFrame:
    travelled = (F.col("distance_km") > 0) & (F.col("duration_min") > 0)
    speed = C.safe_divide("distance_km", F.col("duration_min") / 60.0)
    return _keyed(bronze["routes"], "route_id").select(
        "route_id", "mission_id", "origin_lat", "origin_lon", "dest_lat", "dest_lon",
        *_rounded(distance_km=2, duration_min=1),
        "waypoints",
        F.when(travelled, C.round_half_up(speed, 1)).alias("avg_speed_kmh"),
        C.tier("distance_km", rules.ROUTE_CATEGORIES).alias("route_category"),
        LOADED,
    )


def route_segments(bronze: Inputs, as_of: dt.datetime) -> DataFrame:
    straight = C.haversine_km("start_lat", "start_lon", "end_lat", "end_lon")
    return _keyed(bronze["route_segments"], "segment_id").select(
        "segment_id", "route_id", "segment_seq", "start_lat", "start_lon", "end_lat", "end_lon",
        *_rounded(distance_km=3, altitude_m=1),
        C.round_half_up(straight, 3).alias("straight_line_km"),
        LOADED,
    )


def weather_data(bronze: Inputs, as_of: dt.datetime) -> DataFrame:
    wind, sight, rain = F.col("wind_speed_kmh"), F.col("visibility_km"), F.col("precipitation_mm")
    severity = F
    for name, (max_wind, min_sight, max_rain) in rules.WEATHER_LIMITS.items():
        severity = severity.when((wind > max_wind) | (sight < min_sight) | (rain > max_rain), name)
    storm_wind, blind_sight, _ = rules.WEATHER_LIMITS["SEVERE"]
    grounded = C.flag((wind > storm_wind) | (sight < blind_sight))
    return _keyed(bronze["weather_data"], "weather_id").select(
        "weather_id", "station_id", "recorded_at",
        *_rounded(temp_c=1, wind_speed_kmh=1, wind_direction_deg=0, visibility_km=1, precipitation_mm=1),
        C.canon("conditions").alias("conditions"),
        severity.otherwise(rules.WEATHER_DEFAULT).alias("weather_severity"),
        (~grounded).alias("is_flyable"),
        LOADED,
    )


FROM_BRONZE: dict[str, Callable[[Inputs, dt.datetime], DataFrame]] = {
    "silver_aircraft": aircraft,
    "silver_customers": customers,
    "silver_delivery_feedback": delivery_feedback,
    "silver_delivery_zones": delivery_zones,
    "silver_depots": depots,
    "silver_flight_logs": flight_logs,
    "silver_maintenance_logs": maintenance_logs,
    "silver_missions": missions,
    "silver_mission_events": mission_events,
    "silver_no_fly_zones": no_fly_zones,
    "silver_orders": orders,
    "silver_parts_inventory": parts_inventory,
    "silver_parts_used": parts_used,
    "silver_routes": routes,
    "silver_route_segments": route_segments,
    "silver_weather_data": weather_data,
}
FROM_SILVER = {"silver_mission_timeline": mission_timeline}
MODELS = (*FROM_BRONZE, *FROM_SILVER)
