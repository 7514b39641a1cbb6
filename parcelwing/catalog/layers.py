"""Queries: bronze, silver and gold models."""

from __future__ import annotations

from parcelwing.catalog.domain_sql import LOAD_TS
from parcelwing.catalog.registry import Context, query
from parcelwing.plans import gold, silver
from parcelwing.sources.schemas import TABLES, source_tag

_DATE = "* REPLACE (CAST(last_maintenance_date AS VARCHAR) AS last_maintenance_date)"
_MIDDLE = "origin_lat + (dest_lat - origin_lat) * 0.5e0 AS waypoints_mid_lat"
SHAPES = {
    "raw_aircraft": _DATE, "silver_aircraft": _DATE, "dim_aircraft": _DATE,
    "raw_routes": f"* EXCLUDE (k), {_MIDDLE}", "silver_routes": f"*, {_MIDDLE}",
}


def _select(name: str) -> str:
    return f"SELECT {SHAPES.get(name, '*')} FROM {name}"


def _bronze_sql(table: str) -> str:
    meta = (f"TIMESTAMP '{LOAD_TS}' AS _loaded_at, '{source_tag(table)}' AS _source_file, "
            f"TIMESTAMP '{LOAD_TS}' AS _dbt_loaded_at")
    return f"SELECT {SHAPES.get(f'raw_{table}', '*')}, {meta} FROM raw_{table}"


for _table in TABLES:
    query(f"bronze_{_table}", _bronze_sql(_table))(lambda c, t=_table: c.bronze[t])
for _model in silver.MODELS:
    query(_model, _select(_model))(lambda c, m=_model: c.silver[m])
for _model in gold.MODELS:
    query(_model, _select(_model))(lambda c, m=_model: c.gold[m])


_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{source_tag(t)}' AS source_tag, count(*) AS loaded_rows FROM raw_{t}" for t in TABLES)


@query("bronze_load", _COUNTS)
def _bronze_load(c: Context):
    """Every source loaded to bronze: rows per table and source tag."""
    from functools import reduce

    from pyspark.sql import functions as F

    counted = [
        c.bronze[t].groupBy(F.lit(t).alias("table_name"), F.col("_source_file").alias("source_tag"))
        .agg(F.count(F.lit(1)).alias("loaded_rows"))
        for t in TABLES
    ]
    return reduce(lambda a, b: a.unionByName(b), counted)
