"""Landed files: declared types, defaults, file metadata, rows set aside; a refresh from files."""

import datetime as dt

from pyspark.sql import functions as F

from parcelwing.plans.layers import Layers
from parcelwing.session import scratch
from parcelwing.sources import adapter, ingest
from parcelwing.sources.schemas import TABLES


def test_rows_that_do_not_fit_are_set_aside(spark):
    path = scratch(spark, "landed")
    lines = ['{"order_id": "a", "priority": "HIGH", "package_weight_kg": 1.5}', '{"order_id": "b", "package_weight_kg": "heavy"}',
             '{"order_id": "c"', '{"order_id": "d", "unknown": 1}', '{"order_id": "e", "created_at": "2024-01-02T03:04:05"}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    good, aside = ingest.read_landed(spark, path, TABLES["orders"].columns, "json", dt.datetime(2024, 1, 1), ingest.DEFAULTS["orders"])
    rows = {r.order_id: r for r in good.collect()}
    assert set(rows) == {"a", "d", "e"} and rows["a"].priority == "HIGH" and rows["d"].priority == "STANDARD"
    assert rows["a"].package_weight_kg == 1.5 and rows["e"].created_at == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert all(r._loaded_at == dt.datetime(2024, 1, 1) and path in r._source_file for r in rows.values())
    assert sorted(r._corrupt_record for r in aside.collect()) == sorted(lines[1:3])
    assert good.columns == [*TABLES["orders"].names, ingest.LOADED_AT, ingest.SOURCE_FILE]


def test_parquet_needs_nothing_set_aside(spark, context):
    path = scratch(spark, "landed")
    context.raw["depots"].write.parquet(path)
    good, aside = ingest.read_landed(spark, path, TABLES["depots"].columns, "parquet", adapter.LOAD_TS)
    assert good.select(*TABLES["depots"].names).exceptAll(context.raw["depots"]).isEmpty() and aside.isEmpty()


def test_sixteen_tables_written_and_read_back(spark, context):
    """All raw tables as JSON lines; the layers over the files equal those over the tables."""
    root = scratch(spark, "landing")
    for name in TABLES:
        context.raw[name].write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(f"{root}/{name}")
    landed = ingest.LandedTables(spark, root, "json", adapter.LOAD_TS)
    assert len(landed) == 16
    for name, table in TABLES.items():
        kept = [c for c, kind in table.types.items() if kind != "variant"]
        filled = context.raw[name].select(kept).fillna(ingest.DEFAULTS.get(name, {}))
        got = landed[name].select(kept)
        assert got.count() == filled.count() and landed.set_aside(name).isEmpty(), name
        assert got.exceptAll(filled).isEmpty() and filled.exceptAll(got).isEmpty(), name
    layers = Layers(landed, adapter.AS_OF, adapter.LOAD_TS, adapter.TEST_LEXICON)
    for name in ("dim_customers", "fct_maintenance"):
        assert layers.gold[name].exceptAll(context.gold[name]).isEmpty(), name
    bronze = layers.bronze["customers"]
    assert bronze.filter(F.col("_dbt_loaded_at").isNull()).isEmpty()
