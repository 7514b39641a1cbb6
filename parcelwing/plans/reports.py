"""Dashboard analytics as DataFrame functions over the gold tables.

Every report ends in a small DataFrame; nothing is collected along the way.
Averages of a measure with known decimals are exact; averages of daily figures
go through `_mean`, which fixes the order of addition by adding scaled integers.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwing.functions import columns as C
from parcelwing.operators import filters, summaries

Gold = Mapping[str, DataFrame]
STATUS_NAMES = {"ACTIVE": "active", "IN_MAINTENANCE": "in_maint", "GROUNDED": "grounded"}


def _rows() -> Column:
    return F.count(F.lit(1))


def _mean(column: str) -> Column:
    """Mean of a measure taken to seven decimals, independent of row order; a report rounds it once."""
    return C.fixed_avg(column, 7)


def latest_and_previous(df: DataFrame, ts: str, measures: list[str]) -> DataFrame:
    """The two newest rows with each measure's change from the row before."""
    two = df.select(ts, *measures).orderBy(F.desc(ts)).limit(2)
    order = Window.orderBy(ts)  # two rows
    deltas = [(F.col(m) - F.lag(m).over(order)).alias(f"{m}_delta") for m in measures]
    return two.select(ts, *measures, *deltas)


# --- operations ---------------------------------------------------------------
def freshness(bronze_orders: DataFrame) -> DataFrame:
    return bronze_orders.agg(F.max("_dbt_loaded_at").alias("refreshed_at"))


def ops_overview(gold: Gold, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Newest day in the range and the change in orders from the day before it."""
    days = filters.between_days(gold["kpi_delivery_performance"], "report_date", start, end)
    shown = ["total_orders", "delivery_success_rate_pct", "avg_customer_rating", "active_aircraft"]
    pair = latest_and_previous(days, "report_date", shown)
    return pair.orderBy(F.desc("report_date")).limit(1).select("report_date", *shown, "total_orders_delta")


def ops_trend(gold: Gold, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Daily series behind the overview's figures; a day without a rating has none."""
    days = filters.between_days(gold["kpi_delivery_performance"], "report_date", start, end)
    return days.select("report_date", "total_orders", "delivery_success_rate_pct", "avg_customer_rating",
                       "active_aircraft").orderBy("report_date")


def daily_brief_text(gold: Gold) -> DataFrame:
    """Newest KPI row as one line of text; missing averages read N/A."""

    def shown(name: str, digits: int | None = None) -> Column:
        value = F.col(name) if digits is None else C.round_half_up(name, digits)
        return F.coalesce(value.cast("string"), F.lit("N/A"))

    row = filters.latest(gold["kpi_delivery_performance"], "report_date")
    parts = [
        ("Date", F.date_format("report_date", "yyyy-MM-dd")),
        ("Orders", shown("total_orders")),
        ("Delivered", shown("delivered_orders")),
        ("Cancelled", shown("cancelled_orders")),
        ("SuccessRate", F.concat(shown("delivery_success_rate_pct", 1), F.lit("%"))),
        ("AvgDeliveryMin", shown("avg_delivery_time_min", 1)),
        ("AvgRating", shown("avg_customer_rating", 2)),
        ("ActiveAircraft", shown("active_aircraft")),
        ("AvgDelayMin", shown("avg_departure_delay_min", 1)),
    ]
    text = F.concat_ws(" ", *[F.concat(F.lit(f"{title}="), value) for title, value in parts])
    return row.select(text.alias("brief"))


# --- fleet ----------------------------------------------------------------------
def fleet(gold: Gold, depot: str | None = None) -> DataFrame:
    return filters.fleet_of_depot(gold["dim_aircraft"], gold["dim_depots"], depot)


def fleet_summary(gold: Gold, depot: str | None = None) -> DataFrame:
    return fleet(gold, depot).agg(
        _rows().alias("total_aircraft"),
        F.count_if(F.col("aircraft_status") == "ACTIVE").alias("active"),
        C.fixed_avg("total_flight_hours", 1).alias("avg_flight_hours"),
        F.sum("total_missions").alias("total_missions"),
    )


def aircraft_by_status(gold: Gold, depot: str | None = None) -> DataFrame:
    return summaries.group_size(fleet(gold, depot), "aircraft_status")


def maintenance_compliance(gold: Gold, depot: str | None = None) -> DataFrame:
    return summaries.group_size(fleet(gold, depot), "maintenance_status")


def anomaly_trend(gold: Gold) -> DataFrame:
    return gold["fct_flight_telemetry"].groupBy("hour_bucket").agg(F.sum("anomaly_count").alias("anomaly_count"))


def top_aircraft(gold: Gold, depot: str | None = None) -> DataFrame:
    best = summaries.top_k(fleet(gold, depot), "completed_missions", "aircraft_id")
    return best.select("aircraft_id", "aircraft_model", "completed_missions", "total_flight_hours")


def depot_overview(gold: Gold) -> DataFrame:
    titles = {
        "depot_name": "depot", "depot_size": "size", "aircraft_count": "aircraft", "active_aircraft": "active",
        "total_inventory_value": "inventory_value", "parts_needing_reorder": "reorder",
    }
    return gold["dim_depots"].select(*[F.col(name).alias(title) for name, title in titles.items()])


def fleet_status_counts(gold: Gold) -> DataFrame:
    status = F.col("aircraft_status")
    return gold["dim_aircraft"].agg(
        _rows().alias("total"),
        *[F.count_if(status == value).alias(name) for value, name in STATUS_NAMES.items()],
        F.count_if(F.col("maintenance_status") == "DUE_SOON").alias("due_soon"),
    )


def depot_status_matrix(gold: Gold) -> DataFrame:
    """Aircraft per depot and status; the depot with most in maintenance is marked."""
    matrix = summaries.status_counts(gold["dim_aircraft"], "depot_name", "aircraft_status", STATUS_NAMES)
    worst = summaries.top_k(matrix, "in_maint", "depot_name", 1).select("depot_name").scalar()
    return matrix.withColumn("is_worst", F.col("depot_name") == worst)


def telemetry_rates(gold: Gold) -> DataFrame:
    """Share of points with an anomaly and alarm totals; zeros for an empty table."""
    totals = gold["fct_flight_telemetry"].agg(
        F.sum("telemetry_points").alias("points"), F.sum("anomaly_count").alias("anomalies"),
        F.sum("low_battery_count").alias("low"), F.sum("overspeed_count").alias("fast"),
    )
    rate = C.round_half_even(C.safe_divide(F.col("anomalies").cast("double"), "points") * 100.0, 1)
    return totals.select(
        F.coalesce(rate, F.lit(0.0)).alias("anomaly_rate_pct"),
        F.coalesce("low", F.lit(0)).alias("low_battery_events"),
        F.coalesce("fast", F.lit(0)).alias("overspeed_events"),
    )


def availability(gold: Gold) -> DataFrame:
    counts = fleet_status_counts(gold)
    ready = (F.col("total") - F.col("in_maint") - F.col("grounded")).cast("double")
    return counts.select(
        C.round_half_even(C.safe_divide(ready, "total") * 100.0).alias("available_pct"),
        C.round_half_even(C.safe_divide(F.col("active").cast("double"), "total") * 100.0).alias("active_pct"),
    )


def utilisation(gold: Gold) -> DataFrame:
    """Mean number of aircraft active per day, in percent of the fleet."""
    daily = gold["kpi_delivery_performance"].agg(C.fixed_avg("active_aircraft", 0).alias("mean_active"))
    size = gold["dim_aircraft"].agg(_rows().alias("n")).scalar()
    whole = C.round_half_even("mean_active")
    return daily.select(
        whole.cast("bigint").alias("avg_active"), size.alias("fleet_size"),
        C.round_half_even(C.safe_divide(whole, size) * 100.0).alias("utilisation_pct"),
    )


# --- routes ---------------------------------------------------------------------
def deliveries(gold: Gold, start: dt.date | None = None, end: dt.date | None = None, depot: str | None = None) -> DataFrame:
    """Deliveries of the chosen days, and of one depot's aircraft if a depot is chosen."""
    rows = filters.between_days(gold["fct_deliveries"], "order_created_at", start, end)
    return rows if depot is None else filters.flown_by(rows, fleet(gold, depot))


def routed(rows: DataFrame) -> DataFrame:
    return filters.require(rows, "route_distance_km")


def route_summary(rows: DataFrame) -> DataFrame:
    return routed(rows).agg(
        C.fixed_avg("route_distance_km", 2).alias("avg_distance_km"),
        C.fixed_avg("planned_duration_min", 1).alias("avg_planned_min"),
        C.fixed_avg("planned_avg_speed", 1).alias("avg_speed_kmh"),
    )


def route_category_mix(rows: DataFrame) -> DataFrame:
    return summaries.value_counts(routed(rows), "route_category")


def speed_by_category(rows: DataFrame) -> DataFrame:
    moving = filters.require(routed(rows), "planned_avg_speed", "route_category")
    return moving.groupBy("route_category").agg(C.fixed_avg("planned_avg_speed", 1).alias("avg_speed_kmh"))


def distance_vs_time(rows: DataFrame, order: Column, points: int = 1000) -> DataFrame:
    timed = filters.require(routed(rows), "delivery_time_min")
    drawn = summaries.bounded_sample(timed, order, "order_id", points)
    return drawn.select("order_id", "route_distance_km", "delivery_time_min", "route_category")


# --- maintenance ------------------------------------------------------------------
def maintenance_summary(gold: Gold) -> DataFrame:
    return gold["fct_maintenance"].agg(
        _rows().alias("total_events"),
        C.fixed_avg("duration_min", 0).alias("avg_duration_min"),
        C.fixed_sum("total_parts_cost", 2).alias("total_parts_cost"),
        F.sum("total_parts_quantity").alias("parts_consumed"),
    )


def maintenance_by_type(gold: Gold) -> DataFrame:
    return summaries.group_size(gold["fct_maintenance"], "maintenance_type")


def maintenance_by_urgency(gold: Gold) -> DataFrame:
    return summaries.group_size(gold["fct_maintenance"], "urgency_level")


def costliest_events(gold: Gold) -> DataFrame:
    top = summaries.top_k(gold["fct_maintenance"], "total_parts_cost", "log_id")
    return top.select("log_id", "aircraft_id", "maintenance_type", "urgency_level", "duration_min",
                      "parts_used_count", "total_parts_cost")


# --- customers --------------------------------------------------------------------
def customer_summary(gold: Gold) -> DataFrame:
    """Customers without a rating count as zero in the mean; a second mean leaves them out."""
    rated = F.when(F.col("avg_rating") != 0, F.col("avg_rating"))
    with_rated = gold["dim_customers"].withColumn("_rated", rated)
    return with_rated.agg(
        _rows().alias("total_customers"), _mean("avg_rating").alias("avg_rating"),
        _mean("_rated").alias("avg_rating_of_rated"),
    )


def rating_distribution(rows: DataFrame) -> DataFrame:
    return summaries.value_counts(rows, "feedback_rating")


def sentiment_breakdown(rows: DataFrame) -> DataFrame:
    return summaries.value_counts(rows, "sentiment_label")


def delivery_time_histogram(rows: DataFrame, most: int = 30) -> DataFrame:
    return summaries.histogram(rows, "delivery_time_min", most)


def rating_trend(gold: Gold, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    days = filters.between_days(gold["kpi_delivery_performance"], "report_date", start, end)
    return days.select("report_date", "avg_customer_rating").orderBy("report_date")


def top_customers(gold: Gold) -> DataFrame:
    best = summaries.top_k(gold["dim_customers"], "total_orders", "customer_id")
    return best.select("customer_name", "total_orders", "delivered_orders", "avg_rating", "avg_sentiment",
                       "avg_delivery_time_min")


# --- executive figures --------------------------------------------------------------
def executive_totals(gold: Gold, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Period totals and means of the daily figures (days weigh equally)."""
    days = filters.between_days(gold["kpi_delivery_performance"], "report_date", start, end)
    means = days.agg(
        *[F.sum(n).alias(n) for n in ("total_orders", "delivered_orders", "cancelled_orders")],
        C.fixed_avg("delivery_success_rate_pct", 1).alias("success"),
        _mean("avg_customer_rating").alias("rating"), _mean("avg_sentiment_score").alias("sentiment"),
        C.fixed_avg("active_aircraft", 0).alias("active"), _mean("avg_departure_delay_min").alias("delay"),
    )
    return means.select(
        "total_orders", "delivered_orders", "cancelled_orders",
        C.round_half_even("success", 1).alias("avg_success_rate_pct"),
        C.round_half_even("rating", 2).alias("avg_rating"),
        C.round_half_even("sentiment", 3).alias("avg_sentiment"),
        C.round_half_even("active").cast("bigint").alias("avg_active_aircraft"),
        C.round_half_even("delay").cast("bigint").alias("avg_delay_min"),
    )


def cancellation_rate(gold: Gold) -> DataFrame:
    totals = gold["kpi_delivery_performance"].agg(
        F.sum("cancelled_orders").alias("cancelled"), F.sum("total_orders").alias("orders"))
    rate = C.safe_divide(F.col("cancelled").cast("double"), "orders") * 100.0
    return totals.select(C.round_half_even(rate, 1).alias("cancellation_rate_pct"))
