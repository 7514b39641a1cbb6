"""Declared schemas of the sixteen raw tables. Nothing is ever inferred."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql.types import StructType


class Table(NamedTuple):
    namespace: str
    key: str
    columns: str

    @property
    def types(self) -> dict[str, str]:
        """Column names and types in declared order."""
        return dict(column.split() for column in self.columns.split(", "))

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.columns)

    @property
    def names(self) -> list[str]:
        return list(self.types)


# fixed values: namespaces, keys, column names and types of the raw data model
TABLES: dict[str, Table] = {
    "flight_logs": Table(
        "FLV6", "flight_log_id",
        "flight_log_id string, aircraft_id string, recorded_at timestamp_ntz, lat double, lon double, "
        "altitude_m double, speed_kmh double, battery_pct double, heading_deg double",
    ),
    "weather_data": Table(
        "FLV6", "weather_id",
        "weather_id string, station_id string, recorded_at timestamp_ntz, temp_c double, wind_speed_kmh double, "
        "wind_direction_deg double, visibility_km double, precipitation_mm double, conditions string",
    ),
    "orders": Table(
        "DELIVERY", "order_id",
        "order_id string, customer_id string, pickup_lat double, pickup_lon double, dropoff_lat double, "
        "dropoff_lon double, package_weight_kg double, priority string, status string, "
        "created_at timestamp_ntz, delivered_at timestamp_ntz",
    ),
    "customers": Table(
        "DELIVERY", "customer_id",
        "customer_id string, name string, email string, phone string, address string, created_at timestamp_ntz",
    ),
    "delivery_feedback": Table(
        "DELIVERY", "feedback_id",
        "feedback_id string, order_id string, customer_id string, rating int, comments string, "
        "feedback_channel string, created_at timestamp_ntz",
    ),
    "missions": Table(
        "API", "mission_id",
        "mission_id string, order_id string, aircraft_id string, status string, planned_departure timestamp_ntz, "
        "actual_departure timestamp_ntz, planned_arrival timestamp_ntz, actual_arrival timestamp_ntz, notes string",
    ),
    "mission_events": Table(
        "API", "event_id",
        "event_id string, mission_id string, event_type string, event_timestamp timestamp_ntz, "
        "description string, lat double, lon double",
    ),
    "delivery_zones": Table(
        "GEO", "zone_id",
        "zone_id string, zone_name string, center_lat double, center_lon double, radius_km double, "
        "zone_type string, is_active boolean",
    ),
    "no_fly_zones": Table(
        "GEO", "nfz_id",
        "nfz_id string, zone_name string, center_lat double, center_lon double, radius_km double, "
        "restriction_type string, effective_from timestamp_ntz, effective_to timestamp_ntz",
    ),
    "routes": Table(
        "OSRM", "route_id",
        "route_id string, mission_id string, origin_lat double, origin_lon double, dest_lat double, "
        "dest_lon double, distance_km double, duration_min double, waypoints variant",
    ),
    "route_segments": Table(
        "OSRM", "segment_id",
        "segment_id string, route_id string, segment_seq int, start_lat double, start_lon double, "
        "end_lat double, end_lon double, distance_km double, altitude_m double",
    ),
    "aircraft": Table(
        "DEPOT", "aircraft_id",
        "aircraft_id string, model string, serial_number string, status string, depot_id string, "
        "total_flight_hours double, last_maintenance_date date",
    ),
    "parts_inventory": Table(
        "DEPOT", "part_id",
        "part_id string, part_name string, category string, quantity_on_hand int, reorder_level int, "
        "unit_cost double, depot_id string",
    ),
    "depots": Table(
        "DEPOT", "depot_id",
        "depot_id string, depot_name string, lat double, lon double, capacity int",
    ),
    "maintenance_logs": Table(
        "RECORDS", "log_id",
        "log_id string, aircraft_id string, maintenance_type string, description string, technician string, "
        "started_at timestamp_ntz, completed_at timestamp_ntz, status string",
    ),
    "parts_used": Table(
        "RECORDS", "usage_id",
        "usage_id string, log_id string, part_id string, quantity_used int, cost double",
    ),
}

# fixed values: child table, child column, parent table (joined on the parent's key)
FOREIGN_KEYS: tuple[tuple[str, str, str], ...] = (
    ("orders", "customer_id", "customers"),
    ("delivery_feedback", "order_id", "orders"),
    ("delivery_feedback", "customer_id", "customers"),
    ("missions", "order_id", "orders"),
    ("missions", "aircraft_id", "aircraft"),
    ("mission_events", "mission_id", "missions"),
    ("routes", "mission_id", "missions"),
    ("route_segments", "route_id", "routes"),
    ("aircraft", "depot_id", "depots"),
    ("parts_inventory", "depot_id", "depots"),
    ("maintenance_logs", "aircraft_id", "aircraft"),
    ("parts_used", "log_id", "maintenance_logs"),
    ("parts_used", "part_id", "parts_inventory"),
    ("flight_logs", "aircraft_id", "aircraft"),
)

LOAD_COLUMNS = ("_loaded_at", "_source_file", "_dbt_loaded_at")


def source_tag(table: str) -> str:
    return f"{TABLES[table].namespace}.{table.upper()}"
