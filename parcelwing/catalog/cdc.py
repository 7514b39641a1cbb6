"""Queries: change data capture and streaming."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwing.catalog.domain_sql import LOAD_TS, customer_columns
from parcelwing.catalog.registry import Context, query
from parcelwing.operators import cdc
from parcelwing.plans.bronze import live, load_columns, to_bronze
from parcelwing.plans.silver import customers, flight_logs
from parcelwing.session import scratch
from parcelwing.sources import adapter
from parcelwing.sources.schemas import TABLES
from parcelwing.streaming import jobs

KEYS = ["customer_id"]


def _version_sql(present: str, suffix: str, added: str) -> str:
    return (f"SELECT {customer_columns(phone_suffix=suffix)} FROM customer WHERE {present} UNION ALL "
            f"SELECT {customer_columns('(c_custkey + 1000000)')} FROM customer WHERE {added}")


_K = "c_custkey"
VERSIONS = {
    "cust_v0": f"SELECT {customer_columns()} FROM customer",
    "cust_v1": _version_sql(f"{_K} % 17 <> 0", f"CASE WHEN {_K} % 11 = 0 THEN '-9' ELSE '' END", f"{_K} % 13 = 0"),
    "cust_v2": _version_sql(
        f"({_K} % 17 <> 0 OR {_K} % 34 = 0)",
        f"CASE WHEN {_K} % 33 = 0 THEN '-8' WHEN {_K} % 11 = 0 AND {_K} % 22 <> 0 THEN '-9' ELSE '' END",
        f"{_K} % 13 = 0 AND {_K} % 26 <> 0"),
}


def _diff_sql(old: str, new: str) -> str:
    def side(mine: str, other: str, action: str) -> str:
        return (f"SELECT a.*, '{action}' AS _cdc_action, b.customer_id IS NOT NULL AS _cdc_is_update, "
                f"sha256(a.customer_id) AS _cdc_row_id FROM {mine} a LEFT JOIN {other} b ON a.customer_id = b.customer_id "
                "WHERE b.customer_id IS NULL OR a.phone <> b.phone")
    return f"{side(old, new, 'DELETE')} UNION ALL {side(new, old, 'INSERT')}"


def _versions(c: Context):
    return adapter.customer_versions(c.spark, c.folder)


@query("cdc_initial_snapshot", "SELECT *, 'INSERT' AS _cdc_action, FALSE AS _cdc_is_update, sha256(customer_id) AS _cdc_row_id "
                               "FROM cust_v0", VERSIONS)
def _initial_snapshot(c):
    return cdc.initial_snapshot(_versions(c)[0], KEYS)


@query("cdc_changes", _diff_sql("cust_v0", "cust_v1"), VERSIONS)
def _changes(c):
    v0, v1, _ = _versions(c)
    return cdc.changes(v0, v1, KEYS)


@query("cdc_net_compaction", _diff_sql("cust_v0", "cust_v2"), VERSIONS)
def _net(c):
    v0, v1, v2 = _versions(c)
    first = cdc.changes(v0, v1, KEYS).withColumn("version", F.lit(1))
    second = cdc.changes(v1, v2, KEYS).withColumn("version", F.lit(2))
    return cdc.net(first.unionByName(second), KEYS, "version")


@query("cdc_metadata", f"SELECT *, TIMESTAMP '{LOAD_TS}' AS _dbt_loaded_at FROM ({_diff_sql('cust_v0', 'cust_v1')})", VERSIONS)
def _metadata(c):
    v0, v1, _ = _versions(c)
    return cdc.with_load_time(cdc.changes(v0, v1, KEYS), adapter.LOAD_TS)


@query("cdc_merge", "SELECT * FROM cust_v1", VERSIONS)
def _merge(c):
    v0, v1, _ = _versions(c)
    return cdc.merge(v0, cdc.changes(v0, v1, KEYS), KEYS)


@query("soft_delete", "SELECT *, FALSE AS _is_deleted, CAST(NULL AS TIMESTAMP) AS _deleted_at FROM cust_v1 UNION ALL "
                      f"SELECT *, TRUE, TIMESTAMP '{LOAD_TS}' FROM cust_v0 WHERE customer_id NOT IN (SELECT customer_id FROM cust_v1)",
       VERSIONS)
def _soft_delete(c):
    v0, v1, _ = _versions(c)
    return cdc.soft_merge(v0, cdc.changes(v0, v1, KEYS), KEYS, adapter.LOAD_TS)


@query("silver_dedup", "SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, "
                       "l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, "
                       "l_returnflag DESC, l_linestatus DESC) AS n FROM lineitem) WHERE n = 1")
def _dedup(c):
    return cdc.dedup(c.table("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("cdc_stream_apply", "SELECT * FROM cust_v2", VERSIONS)
def _stream_apply(c):
    """Two change sets arrive in one batch and the first once more; the state equals the last version."""
    v0, v1, v2 = _versions(c)
    inbox, log = scratch(c.spark, "changes"), scratch(c.spark, "log")
    checkpoint = scratch(c.spark, "checkpoint")
    first, second = cdc.stamped(cdc.changes(v0, v1, KEYS), 1), cdc.stamped(cdc.changes(v1, v2, KEYS), 2)
    for arriving in (second, first):
        arriving.write.mode("append").parquet(inbox)
    jobs.apply_changes(jobs.change_stream(c.spark, inbox, first.schema), log, checkpoint)
    first.write.mode("append").parquet(inbox)
    jobs.apply_changes(jobs.change_stream(c.spark, inbox, first.schema), log, checkpoint)
    return jobs.current_state(v0, log, KEYS, after=0)


def _all_tables_sql() -> str:
    """Rows of each action in each table, from the rule that makes the second version."""
    parts = []
    for name, table in TABLES.items():
        k = f"CAST(regexp_extract({table.key}, '[0-9]+') AS BIGINT)"
        moved = f"{k} % 11 = 2 AND {table.names[1]} IS NOT NULL"
        parts.append(
            f"SELECT '{name}' AS table_name, CAST(count(*) FILTER (WHERE {k} % 17 = 0 AND {k} % 13 <> 1) AS BIGINT) AS deleted, "
            f"CAST(count(*) FILTER (WHERE {k} % 13 = 1 AND {k} % 17 <> 0) AS BIGINT) AS inserted, "
            f"CAST(count(*) FILTER (WHERE {k} % 17 <> 0 AND {k} % 13 <> 1 AND {moved}) AS BIGINT) AS updated FROM raw_{name}")
    return " UNION ALL ".join(parts)


@query("cdc_all_tables", _all_tables_sql())
def _all_tables(c):
    """Change capture over all raw tables at once: rows deleted, inserted and updated in each."""
    old, new = {}, {}
    for name, table in TABLES.items():
        rows, second = c.raw[name], table.names[1]
        k = F.regexp_extract(table.key, "[0-9]+", 0).cast("bigint")
        old[name] = rows.filter(k % 13 != 1)
        moved = F.when(k % 11 == 2, F.lit(None)).otherwise(F.col(second)).cast(rows.schema[second].dataType)
        new[name] = rows.filter(k % 17 != 0).withColumn(second, moved)
    captured = cdc.capture(old, new, {n: t.key for n, t in TABLES.items()}, 1)
    update, gone = F.col(cdc.IS_UPDATE), F.col(cdc.ACTION) == cdc.DELETE
    counted = [
        rows.agg(F.count_if(gone & ~update).alias("deleted"), F.count_if(~gone & ~update).alias("inserted"),
                 F.count_if(~gone & update).alias("updated")).select(F.lit(name).alias("table_name"), "*")
        for name, rows in captured.items()]
    return reduce(DataFrame.unionByName, counted)


@query("soft_delete_layers", "SELECT customer_id, customer_name, email, phone_clean FROM silver_customers",
       VERSIONS | {"raw_customers": "SELECT * FROM cust_v1"})
def _soft_delete_layers(c):
    """Deletions, updates and inserts of customers through bronze: silver shows the second version only."""
    v0, v1, _ = _versions(c)
    arriving = cdc.changes(v0, v1, KEYS).withColumns(load_columns("customers", adapter.LOAD_TS))
    bronze = cdc.soft_merge(to_bronze(v0, "customers", adapter.LOAD_TS), arriving, KEYS, adapter.LOAD_TS)
    return customers({"customers": live(bronze)}, adapter.AS_OF).select("customer_id", "customer_name", "email", "phone_clean")


@query("telemetry_hourly_stream", "SELECT * FROM fct_flight_telemetry")
def _hourly_stream(c):
    streams = adapter.StreamingTables(c.spark, c.folder)
    bronze = {"flight_logs": to_bronze(streams["flight_logs"], "flight_logs", adapter.LOAD_TS)}
    folder = scratch(c.spark, "telemetry")
    jobs.run_hourly_telemetry(flight_logs(bronze, adapter.AS_OF), folder, scratch(c.spark, "checkpoint"))
    return jobs.read_hourly_telemetry(c.spark, folder)
