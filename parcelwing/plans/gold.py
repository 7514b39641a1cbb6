"""Gold layer: four dimensions, three facts and the daily delivery KPI.

Child tables are aggregated to their parent's key before they are joined, so
no join fans out and a hot parent arrives as one partial row per task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwing.functions import columns as C
from parcelwing.operators.joins import HOT_ROWS, crowded_keys, left_join

Inputs = Mapping[str, DataFrame]


def _rows() -> Column:
    return F.count(F.lit(1))


def _zero_filled(*names: str) -> list[Column]:
    return [F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names]


def dim_aircraft(silver: Inputs, as_of: dt.datetime) -> DataFrame:
    flown = silver["silver_missions"].groupBy("aircraft_id").agg(
        _rows().alias("total_missions"),
        C.count_if(F.col("mission_status") == "COMPLETED").alias("completed_missions"),
        F.max("actual_departure").alias("last_mission_at"),
    )
    serviced = silver["silver_maintenance_logs"].groupBy("aircraft_id").agg(_rows().alias("total_maintenance_events"))
    home = silver["silver_depots"].select("depot_id", "depot_name")
    fleet = silver["silver_aircraft"]
    joined = fleet.join(flown, "aircraft_id", "left").join(serviced, "aircraft_id", "left").join(home, "depot_id", "left")
    return joined.select(
        "aircraft_id", "aircraft_model", "serial_number", "aircraft_status", "depot_id", "depot_name",
        "total_flight_hours", "last_maintenance_date", "maintenance_status", "usage_tier",
        *_zero_filled("total_missions", "completed_missions", "total_maintenance_events"),
        "last_mission_at",
    )


def dim_customers(silver: Inputs, as_of: dt.datetime) -> DataFrame:
    ordered = silver["silver_orders"].groupBy("customer_id").agg(
        _rows().alias("total_orders"),
        C.count_if(F.col("order_status") == "DELIVERED").alias("delivered_orders"),
        F.max("created_at").alias("last_order_at"),
        C.fixed_avg("delivery_time_min", 0).alias("avg_delivery_time_min"),
    )
    rated = silver["silver_delivery_feedback"].groupBy("customer_id").agg(
        C.fixed_avg("rating", 0).alias("avg_rating"),
        C.fixed_avg("sentiment_score", 4).alias("avg_sentiment"),
    )
    joined = silver["silver_customers"].join(ordered, "customer_id", "left").join(rated, "customer_id", "left")
    return joined.select(
        "customer_id", "customer_name", "email",
        F.col("phone_clean").alias("phone"),
        "address",
        F.col("created_at").alias("customer_since"),
        *_zero_filled("total_orders", "delivered_orders", "avg_rating", "avg_sentiment"),
        "last_order_at",
        *_zero_filled("avg_delivery_time_min"),
    )


def dim_delivery_zones(silver: Inputs, as_of: dt.datetime) -> DataFrame:
    return silver["silver_delivery_zones"].drop("_dbt_loaded_at")


def dim_depots(silver: Inputs, as_of: dt.datetime) -> DataFrame:
    fleet = silver["silver_aircraft"].groupBy("depot_id").agg(
        _rows().alias("aircraft_count"),
        C.count_if(F.col("aircraft_status") == "ACTIVE").alias("active_aircraft"),
    )
    stock = silver["silver_parts_inventory"].groupBy("depot_id").agg(
        C.fixed_sum("inventory_value", 2).alias("total_inventory_value"),
        C.count_if(F.col("stock_status") == "REORDER_NEEDED").alias("parts_needing_reorder"),
    )
    joined = silver["silver_depots"].join(fleet, "depot_id", "left").join(stock, "depot_id", "left")
    return joined.select(
        "depot_id", "depot_name", "lat", "lon", "capacity", "depot_size",
        *_zero_filled("aircraft_count", "active_aircraft", "total_inventory_value", "parts_needing_reorder"),
    )


def crowded_parents(bronze: Inputs, hot_rows: int = HOT_ROWS) -> dict[str, dict]:
    """Parents with very many children in the joins of `fct_deliveries`, counted once when the tables are written."""
    routes = bronze["routes"].filter(F.col("mission_id").isNotNull()).groupBy("mission_id").agg(_rows().alias("_routes"))
    flights = bronze["missions"].select("mission_id", "order_id").join(routes, "mission_id", "left")
    flights = flights.withColumn("_rows_each", F.coalesce("_routes", F.lit(1)))
    return {
        "routes of a mission": crowded_keys(bronze["routes"], "mission_id", hot_rows=hot_rows),
        "flights of an order": crowded_keys(flights, "order_id", "_rows_each", hot_rows),
        "feedback of an order": crowded_keys(bronze["delivery_feedback"], "order_id", hot_rows=hot_rows),
    }


def fct_deliveries(silver: Inputs, as_of: dt.datetime) -> DataFrame:
    """Order grain; an order with several missions or comments yields several rows.

    Routes are attached to missions first, so orders without a mission carry
    no null key into a further join, and both joins of orders use the order id.
    Each child side may be crowded on one parent, hence `left_join`; which parents
    are is known since the tables were written (`crowded_parents`).
    """
    flights = silver["silver_missions"].select(
        "mission_id", "order_id", "aircraft_id", "mission_status", "actual_departure", "actual_arrival",
        F.col("actual_duration_min").alias("flight_duration_min"), "departure_delay_min",
    )
    paths = silver["silver_routes"].select(
        "route_id", "mission_id",
        F.col("distance_km").alias("route_distance_km"),
        F.col("duration_min").alias("planned_duration_min"),
        F.col("avg_speed_kmh").alias("planned_avg_speed"),
        "route_category",
    )
    opinions = silver["silver_delivery_feedback"].select(
        "feedback_id", "order_id", F.col("rating").alias("feedback_rating"), "sentiment_score", "sentiment_label"
    )
    flights = flights.filter(F.col("order_id").isNotNull())
    crowded = getattr(silver, "crowded", {})
    routed = left_join(flights, paths, "mission_id", ["route_id"], crowded=crowded.get("routes of a mission", {}))
    flown = left_join(silver["silver_orders"], routed, "order_id", ["mission_id", "route_id"],
                      crowded=crowded.get("flights of an order", {}))
    joined = left_join(flown, opinions, "order_id", ["feedback_id"], crowded=crowded.get("feedback of an order", {}))
    return joined.select(
        "order_id", "customer_id", "mission_id", "aircraft_id", "priority", "order_status", "mission_status",
        "package_weight_kg", "straight_line_distance_km", "route_distance_km", "planned_duration_min",
        "planned_avg_speed", "route_category",
        F.col("created_at").alias("order_created_at"),
        "actual_departure", "actual_arrival", "delivered_at", "delivery_time_min", "flight_duration_min",
        "departure_delay_min", "feedback_rating", "sentiment_score", "sentiment_label",
    )


# averaged measures of the hourly telemetry fact: source column, decimals, result column
TELEMETRY_AVERAGES = (
    ("altitude_m", 1, "avg_altitude_m"), ("speed_kmh", 1, "avg_speed_kmh"), ("battery_pct", 1, "avg_battery_pct"))
TELEMETRY_EXTREMES = (
    ("max", "altitude_m", "max_altitude_m"), ("max", "speed_kmh", "max_speed_kmh"), ("min", "battery_pct", "min_battery_pct"))
TELEMETRY_FLAGS = (
    ("has_anomaly", "anomaly_count"), ("is_low_battery", "low_battery_count"), ("is_overspeed", "overspeed_count"))
TELEMETRY_COLUMNS = ("telemetry_points", "avg_altitude_m", "max_altitude_m", "avg_speed_kmh", "max_speed_kmh",
                     "min_battery_pct", "avg_battery_pct", "anomaly_count", "low_battery_count", "overspeed_count")


def telemetry_measures() -> list[Column]:
    """Aggregates of the hourly telemetry fact."""
    made = {"telemetry_points": _rows()}
    made |= {name: C.fixed_avg(source, digits) for source, digits, name in TELEMETRY_AVERAGES}
    made |= {name: getattr(F, end)(source) for end, source, name in TELEMETRY_EXTREMES}
    made |= {name: C.count_if(F.col(flag)) for flag, name in TELEMETRY_FLAGS}
    return [made[name].alias(name) for name in TELEMETRY_COLUMNS]


def telemetry_partials() -> list[Column]:
    """Aggregates of some of an hour's rows, from which `telemetry_totals` makes those of all."""
    parts = [_rows().alias("telemetry_points")]
    for source, digits, name in TELEMETRY_AVERAGES:
        parts += [F.sum(C.fixed_units(source, digits)).alias(f"{name}_sum"), F.count(source).alias(f"{name}_n")]
    parts += [getattr(F, end)(source).alias(name) for end, source, name in TELEMETRY_EXTREMES]
    return parts + [C.count_if(F.col(flag)).alias(name) for flag, name in TELEMETRY_FLAGS]


def telemetry_totals() -> list[Column]:
    """Aggregates of the hourly telemetry fact over partial ones, the same to the last bit."""
    made = {"telemetry_points": F.sum("telemetry_points")}
    for _, digits, name in TELEMETRY_AVERAGES:
        made[name] = C.safe_divide(F.sum(f"{name}_sum").cast("double"), F.sum(f"{name}_n") * F.lit(10.0**digits))
    made |= {name: getattr(F, end)(name) for end, _, name in TELEMETRY_EXTREMES}
    made |= {name: F.sum(name) for _, name in TELEMETRY_FLAGS}
    return [made[name].alias(name) for name in TELEMETRY_COLUMNS]


def fct_flight_telemetry(silver: Inputs, as_of: dt.datetime) -> DataFrame:
    hour = C.trunc_to("hour", "recorded_at").alias("hour_bucket")
    return silver["silver_flight_logs"].groupBy("aircraft_id", hour).agg(*telemetry_measures())


def fct_maintenance(silver: Inputs, as_of: dt.datetime) -> DataFrame:
    parts = silver["silver_parts_used"].groupBy("log_id").agg(
        _rows().alias("parts_used_count"),
        F.sum("quantity_used").alias("total_parts_quantity"),
        C.fixed_sum("cost", 2).alias("total_parts_cost"),
    )
    return silver["silver_maintenance_logs"].join(parts, "log_id", "left").select(
        "log_id", "aircraft_id", "maintenance_type", "description", "technician", "started_at", "completed_at",
        "maintenance_status", "duration_min", "urgency_level",
        *_zero_filled("parts_used_count", "total_parts_quantity", "total_parts_cost"),
    )


# averaged measures of the daily KPI: source column, decimals, result column
KPI_AVERAGES = (
    ("delivery_time_min", 0, "avg_delivery_time_min"),
    ("route_distance_km", 2, "avg_route_distance_km"),
    ("feedback_rating", 0, "avg_customer_rating"),
    ("sentiment_score", 4, "avg_sentiment_score"),
    ("departure_delay_min", 0, "avg_departure_delay_min"),
)


def kpi_delivery_performance(gold: Inputs, as_of: dt.datetime) -> DataFrame:
    """Daily delivery figures, in two aggregation steps over one scan.

    An exact median and an exact distinct count in one grouping would push
    every row through the object-based aggregate. Instead each row is counted
    once under its delivery time and once under its aircraft. The first step is
    a plain hash aggregate of sums that combines before the shuffle; the second
    sees only (day, minutes, frequency) and (day, aircraft) and yields both.
    """
    facts = gold["fct_deliveries"].withColumn("report_date", C.trunc_to("day", "order_created_at"))
    no_minutes, no_aircraft = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    views = F.array(
        F.struct(F.lit(True).alias("by_time"), F.col("delivery_time_min").alias("minutes"), no_aircraft.alias("flyer")),
        F.struct(F.lit(False).alias("by_time"), no_minutes.alias("minutes"), F.col("aircraft_id").alias("flyer")),
    )
    status = F.col("order_status")
    keyed = facts.select("report_date", F.explode(views).alias("_v"), status.alias("_status"),
                         *[F.col(source) for source, _, _ in KPI_AVERAGES])
    keys = ["report_date", "_v.by_time", "_v.minutes", "_v.flyer"]
    partial = [
        _rows().alias("orders"),
        C.count_if(F.col("_status") == "DELIVERED").alias("delivered"),
        C.count_if(F.col("_status") == "CANCELLED").alias("cancelled"),
    ]
    for source, digits, name in KPI_AVERAGES:
        partial += [F.sum(C.fixed_units(source, digits)).alias(f"{name}_sum"), F.count(source).alias(f"{name}_n")]
    groups = keyed.groupBy(*keys).agg(*partial)

    def total(name: str) -> Column:
        return F.sum(F.when(F.col("by_time"), F.col(name)))

    def average(digits: int, name: str) -> Column:
        return C.safe_divide(total(f"{name}_sum").cast("double"), total(f"{name}_n") * F.lit(10.0**digits)).alias(name)

    averages = {name: average(digits, name) for _, digits, name in KPI_AVERAGES}
    return groups.groupBy("report_date").agg(
        total("orders").alias("total_orders"),
        total("delivered").alias("delivered_orders"),
        total("cancelled").alias("cancelled_orders"),
        C.percent(total("delivered"), total("orders")).alias("delivery_success_rate_pct"),
        averages["avg_delivery_time_min"],
        F.percentile("minutes", F.lit(0.5), F.col("orders")).alias("median_delivery_time_min"),
        averages["avg_route_distance_km"],
        averages["avg_customer_rating"],
        averages["avg_sentiment_score"],
        F.count("flyer").alias("active_aircraft"),
        averages["avg_departure_delay_min"],
    )


FROM_SILVER: dict[str, Callable[[Inputs, dt.datetime], DataFrame]] = {
    "dim_aircraft": dim_aircraft,
    "dim_customers": dim_customers,
    "dim_delivery_zones": dim_delivery_zones,
    "dim_depots": dim_depots,
    "fct_deliveries": fct_deliveries,
    "fct_flight_telemetry": fct_flight_telemetry,
    "fct_maintenance": fct_maintenance,
}
FROM_GOLD = {"kpi_delivery_performance": kpi_delivery_performance}
MODELS = (*FROM_SILVER, *FROM_GOLD)
