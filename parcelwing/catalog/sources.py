"""Queries: scans, literal and sequence sources, sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from parcelwing.catalog.domain_sql import LOAD_TS
from parcelwing.catalog.registry import query
from parcelwing.session import scratch
from parcelwing.sources import ingest, tables
from parcelwing.sources.adapter import SOURCE_SCHEMAS

# fixed values: short names of the order states in the test data
STATES = (("F", "finished"), ("O", "open"), ("P", "partial"))


@query("raw_scan", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def _raw_scan(c):
    scan = tables.read_typed(c.spark, f"{c.folder}/orders.parquet", SOURCE_SCHEMAS["orders"])
    return scan.select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("values_source", "SELECT o_orderkey, title FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial')) "
                        "AS s(o_orderstatus, title) USING (o_orderstatus)")
def _values_source(c):
    states = tables.literal_table(c.spark, STATES, "o_orderstatus string, title string")
    return c.table("orders").join(states, "o_orderstatus").select("o_orderkey", "title")


@query("sequence_source", "SELECT o_orderkey, unnest(range(o_orderkey % 5 + 1)) AS step FROM orders")
def _sequence_source(c):
    steps = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("o_orderkey") % 5))
    return c.table("orders").select("o_orderkey", steps.alias("step"))


@query("append_sink", "SELECT customer_id, email FROM raw_customers UNION ALL SELECT depot_id, depot_name FROM raw_depots")
def _append_sink(c):
    path = scratch(c.spark, "append")
    tables.append(c.raw["customers"].select("customer_id", "email"), path)
    depots = c.raw["depots"]
    tables.append(depots.select(F.col("depot_id").alias("customer_id"), F.col("depot_name").alias("email")), path)
    return tables.read_typed(c.spark, path, "customer_id string, email string")


@query("full_refresh_sink", "SELECT customer_id, name, _source_file, _dbt_loaded_at FROM (SELECT *, 'DELIVERY.CUSTOMERS' AS _source_file, "
                            f"TIMESTAMP '{LOAD_TS}' AS _dbt_loaded_at FROM raw_customers)")
def _full_refresh_sink(c):
    """Published twice: the second refresh replaces the first."""
    root = scratch(c.spark, "refresh")
    for _ in range(2):
        tables.publish_table(c.bronze["customers"], root, "bronze", "bronze_customers")
    back = tables.read_table(c.spark, root, "bronze", "bronze_customers")
    return back.select("customer_id", "name", "_source_file", "_dbt_loaded_at")


@query("view_publish", "SELECT customer_id, customer_name, phone_clean FROM silver_customers")
def _view_publish(c):
    view = tables.publish_view(c.silver["silver_customers"], "published_customers")
    return view.select("customer_id", "customer_name", "phone_clean")


@query("gold_read", "SELECT aircraft_id, hour_bucket, telemetry_points, max_speed_kmh FROM fct_flight_telemetry")
def _gold_read(c):
    """The telemetry fact is stored by day and read back without the folder column."""
    root = scratch(c.spark, "gold")
    tables.publish_table(c.gold["fct_flight_telemetry"], root, "gold", "fct_flight_telemetry")
    back = tables.read_gold(c.spark, "fct_flight_telemetry", root)
    return back.select("aircraft_id", "hour_bucket", "telemetry_points", "max_speed_kmh")


@query("gold_read_days", "SELECT aircraft_id, hour_bucket, telemetry_points FROM fct_flight_telemetry "
                         "WHERE hour_bucket >= TIMESTAMP '2024-01-05' AND hour_bucket < TIMESTAMP '2024-01-12'")
def _gold_read_days(c):
    """A week of the telemetry fact: only the folders of these days are opened."""
    root = scratch(c.spark, "gold")
    tables.publish_table(c.gold["fct_flight_telemetry"], root, "gold", "fct_flight_telemetry")
    week = tables.read_gold(c.spark, "fct_flight_telemetry", root, dt.date(2024, 1, 5), dt.date(2024, 1, 11))
    return week.select("aircraft_id", "hour_bucket", "telemetry_points")


@query("raw_ingest", "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, TRUE AS from_file FROM orders")
def _raw_ingest(c):
    """Text files that land as they are, read by the declared types: rows that do not fit are set aside."""
    landed, kinds = scratch(c.spark, "landed"), "o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"
    names = [kind.split()[0] for kind in kinds.split(", ")]
    rows = c.table("orders").select([F.col(n).cast("string") for n in names])
    spoilt = rows.filter(F.col("o_orderkey").cast("bigint") % 50 == 0).withColumn("o_totalprice", F.lit("not a number"))
    rows.unionByName(spoilt).write.csv(landed)
    good, _ = ingest.read_landed(c.spark, landed, kinds, "csv")
    return good.select(*names, F.col(ingest.SOURCE_FILE).contains("landed").alias("from_file"))
