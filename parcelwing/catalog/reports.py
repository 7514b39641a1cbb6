"""Queries: dashboard reports over the gold tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelwing.catalog.domain_sql import count_if, even, favg, fsum, rnd
from parcelwing.catalog.registry import query
from parcelwing.plans import reports as R

_ROUTED = "(SELECT * FROM fct_deliveries WHERE route_distance_km IS NOT NULL)"


def _mean(expr: str) -> str:
    return favg(expr, 7)


def _is(column: str, value: str) -> str:
    return f"{column} = '{value}'"


def _rows(c):
    return R.deliveries(c.gold)


def report(name: str, sql: str, build) -> None:
    query(name, sql)(build)


report("freshness", "SELECT max(_dbt_loaded_at) AS refreshed_at FROM silver_orders",
       lambda c: R.freshness(c.bronze["orders"]))
report("ops_overview",
       "SELECT report_date, total_orders, delivery_success_rate_pct, avg_customer_rating, active_aircraft, "
       "total_orders - prev AS total_orders_delta FROM (SELECT *, lag(total_orders) OVER (ORDER BY report_date) AS prev "
       "FROM kpi_delivery_performance) "
       "ORDER BY report_date DESC LIMIT 1",
       lambda c: R.ops_overview(c.gold))
report("ops_trend",
       "SELECT report_date, total_orders, delivery_success_rate_pct, avg_customer_rating, active_aircraft FROM kpi_delivery_performance",
       lambda c: R.ops_trend(c.gold))
_NA = "coalesce(CAST({} AS VARCHAR), 'N/A')".format
report("daily_brief_text",
       "SELECT 'Date=' || strftime(report_date, '%Y-%m-%d') || ' Orders=' || total_orders || ' Delivered=' || delivered_orders "
       f"|| ' Cancelled=' || cancelled_orders || ' SuccessRate=' || {_NA(rnd('delivery_success_rate_pct', 1))} || '%' "
       f"|| ' AvgDeliveryMin=' || {_NA(rnd('avg_delivery_time_min', 1))} || ' AvgRating=' || {_NA(rnd('avg_customer_rating', 2))} "
       f"|| ' ActiveAircraft=' || active_aircraft || ' AvgDelayMin=' || {_NA(rnd('avg_departure_delay_min', 1))} AS brief "
       "FROM kpi_delivery_performance WHERE report_date = (SELECT max(report_date) FROM kpi_delivery_performance)",
       lambda c: R.daily_brief_text(c.gold))
report("fleet_summary",
       f"SELECT count(*) AS total_aircraft, {count_if(_is('aircraft_status', 'ACTIVE'))} AS active, "
       f"{favg('total_flight_hours', 1)} AS avg_flight_hours, CAST(sum(total_missions) AS BIGINT) AS total_missions FROM dim_aircraft",
       lambda c: R.fleet_summary(c.gold))
report("aircraft_by_status", "SELECT aircraft_status, count(*) AS count FROM dim_aircraft GROUP BY ALL",
       lambda c: R.aircraft_by_status(c.gold))
report("maintenance_compliance", "SELECT maintenance_status, count(*) AS count FROM dim_aircraft GROUP BY ALL",
       lambda c: R.maintenance_compliance(c.gold))
report("anomaly_trend", "SELECT hour_bucket, CAST(sum(anomaly_count) AS BIGINT) AS anomaly_count FROM fct_flight_telemetry GROUP BY ALL",
       lambda c: R.anomaly_trend(c.gold))
report("top_aircraft", "SELECT aircraft_id, aircraft_model, completed_missions, total_flight_hours FROM dim_aircraft "
                       "ORDER BY completed_missions DESC, aircraft_id LIMIT 10",
       lambda c: R.top_aircraft(c.gold))
report("depot_overview", "SELECT depot_name AS depot, depot_size AS size, aircraft_count AS aircraft, active_aircraft AS active, "
                         "total_inventory_value AS inventory_value, parts_needing_reorder AS reorder FROM dim_depots",
       lambda c: R.depot_overview(c.gold))
report("route_summary", f"SELECT {favg('route_distance_km', 2)} AS avg_distance_km, {favg('planned_duration_min', 1)} AS avg_planned_min, "
                        f"{favg('planned_avg_speed', 1)} AS avg_speed_kmh FROM {_ROUTED}",
       lambda c: R.route_summary(_rows(c)))
report("route_category_mix", f"SELECT route_category, count(*) AS count FROM {_ROUTED} GROUP BY ALL",
       lambda c: R.route_category_mix(_rows(c)))
report("speed_by_category", f"SELECT route_category, {favg('planned_avg_speed', 1)} AS avg_speed_kmh FROM {_ROUTED} "
                            "WHERE planned_avg_speed IS NOT NULL GROUP BY route_category",
       lambda c: R.speed_by_category(_rows(c)))


@query("distance_vs_time", f"SELECT order_id, route_distance_km, delivery_time_min, route_category FROM {_ROUTED} "
                           "WHERE delivery_time_min IS NOT NULL ORDER BY CAST(substr(order_id, 5) AS BIGINT) * 7919 % 1000003, order_id LIMIT 1000")
def _distance_vs_time(c):
    number = F.substring("order_id", 5, 20).cast("bigint")
    return R.distance_vs_time(_rows(c), number * 7919 % 1000003)


report("maintenance_summary",
       f"SELECT count(*) AS total_events, {favg('duration_min', 0)} AS avg_duration_min, {fsum('total_parts_cost', 2)} AS total_parts_cost, "
       "CAST(sum(total_parts_quantity) AS BIGINT) AS parts_consumed FROM fct_maintenance",
       lambda c: R.maintenance_summary(c.gold))
report("maintenance_by_type", "SELECT maintenance_type, count(*) AS count FROM fct_maintenance GROUP BY ALL",
       lambda c: R.maintenance_by_type(c.gold))
report("maintenance_by_urgency", "SELECT urgency_level, count(*) AS count FROM fct_maintenance GROUP BY ALL",
       lambda c: R.maintenance_by_urgency(c.gold))
report("costliest_events", "SELECT log_id, aircraft_id, maintenance_type, urgency_level, duration_min, parts_used_count, total_parts_cost "
                           "FROM fct_maintenance ORDER BY total_parts_cost DESC, log_id LIMIT 10",
       lambda c: R.costliest_events(c.gold))
report("customer_summary",
       f"SELECT count(*) AS total_customers, {_mean('avg_rating')} AS avg_rating, {_mean('nullif(avg_rating, 0e0)')} AS avg_rating_of_rated "
       "FROM dim_customers",
       lambda c: R.customer_summary(c.gold))
report("rating_distribution", "SELECT feedback_rating, count(*) AS count FROM fct_deliveries WHERE feedback_rating IS NOT NULL GROUP BY ALL",
       lambda c: R.rating_distribution(_rows(c)))
report("delivery_time_histogram",
       "SELECT bin * step AS bin_start, (bin + 1) * step AS bin_end, CAST(count(*) AS BIGINT) AS frequency FROM (SELECT step, "
       "CAST(floor(delivery_time_min / step) AS BIGINT) AS bin FROM fct_deliveries, (SELECT min(s) AS step FROM (SELECT unnest([1e0, 2e0, 5e0, 1e1, 2e1, 5e1, 1e2]) AS s), "
       "(SELECT min(delivery_time_min) AS lo, max(delivery_time_min) AS hi FROM fct_deliveries) WHERE floor(hi / s) - floor(lo / s) < 30) "
       "WHERE delivery_time_min IS NOT NULL) GROUP BY bin, step",
       lambda c: R.delivery_time_histogram(c.gold["fct_deliveries"]))
report("rating_trend", "SELECT report_date, avg_customer_rating FROM kpi_delivery_performance",
       lambda c: R.rating_trend(c.gold))
report("top_customers", "SELECT customer_name, total_orders, delivered_orders, avg_rating, avg_sentiment, avg_delivery_time_min "
                        "FROM dim_customers ORDER BY total_orders DESC, customer_id LIMIT 10",
       lambda c: R.top_customers(c.gold))
report("executive_totals",
       "SELECT CAST(sum(total_orders) AS BIGINT) AS total_orders, CAST(sum(delivered_orders) AS BIGINT) AS delivered_orders, "
       "CAST(sum(cancelled_orders) AS BIGINT) AS cancelled_orders, "
       f"{even(favg('delivery_success_rate_pct', 1), 1)} AS avg_success_rate_pct, {even(_mean('avg_customer_rating'), 2)} AS avg_rating, "
       f"{even(_mean('avg_sentiment_score'), 3)} AS avg_sentiment, CAST({even(favg('active_aircraft', 0))} AS BIGINT) AS avg_active_aircraft, "
       f"CAST({even(_mean('avg_departure_delay_min'))} AS BIGINT) AS avg_delay_min FROM kpi_delivery_performance",
       lambda c: R.executive_totals(c.gold))
report("fleet_status_counts",
       "SELECT count(*) AS total, " + ", ".join(f"{count_if(_is('aircraft_status', k))} AS {v}" for k, v in R.STATUS_NAMES.items())
       + f", {count_if(_is('maintenance_status', 'DUE_SOON'))} AS due_soon FROM dim_aircraft",
       lambda c: R.fleet_status_counts(c.gold))
report("depot_status_matrix",
       "SELECT *, depot_name = first_value(depot_name) OVER (ORDER BY in_maint DESC, depot_name) AS is_worst FROM (SELECT depot_name, "
       + ", ".join(f"{count_if(_is('aircraft_status', k))} AS {v}" for k, v in R.STATUS_NAMES.items())
       + " FROM dim_aircraft WHERE depot_name IS NOT NULL GROUP BY depot_name)",
       lambda c: R.depot_status_matrix(c.gold))
report("telemetry_rates",
       f"SELECT {even('(CAST(sum(anomaly_count) AS DOUBLE) / sum(telemetry_points) * 1e2)', 1)} AS anomaly_rate_pct, "
       "CAST(sum(low_battery_count) AS BIGINT) AS low_battery_events, CAST(sum(overspeed_count) AS BIGINT) AS overspeed_events "
       "FROM fct_flight_telemetry",
       lambda c: R.telemetry_rates(c.gold))
_READY = count_if("aircraft_status NOT IN ('IN_MAINTENANCE', 'GROUNDED')")
_ACTIVE = count_if("aircraft_status = 'ACTIVE'")
report("availability",
       f"SELECT {even(f'(CAST({_READY} AS DOUBLE) / count(*) * 1e2)')} AS available_pct, "
       f"{even(f'(CAST({_ACTIVE} AS DOUBLE) / count(*) * 1e2)')} AS active_pct FROM dim_aircraft",
       lambda c: R.availability(c.gold))
report("cancellation_rate",
       f"SELECT {even('(CAST(sum(cancelled_orders) AS DOUBLE) / sum(total_orders) * 1e2)', 1)} AS cancellation_rate_pct FROM kpi_delivery_performance",
       lambda c: R.cancellation_rate(c.gold))
report("utilisation",
       "SELECT CAST(active AS BIGINT) AS avg_active, fleet AS fleet_size, "
       f"{even('(active / fleet * 1e2)')} AS utilisation_pct FROM (SELECT {even(favg('active_aircraft', 0))} AS active, "
       "(SELECT count(*) FROM dim_aircraft) AS fleet FROM kpi_delivery_performance)",
       lambda c: R.utilisation(c.gold))
