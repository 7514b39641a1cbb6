"""Versioned tables, snapshots, day folders, and change sets through the layers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from parcelwing.operators import cdc
from parcelwing.plans import incremental
from parcelwing.plans.layers import Layers, refresh
from parcelwing.session import scratch
from parcelwing.sources import adapter, tables
from parcelwing.sources.schemas import TABLES
from parcelwing.sources.versions import Conflict, VersionedTable

DAY = dt.date(2024, 1, 3)


@pytest.fixture
def dated(spark):
    rows = spark.range(100).select("id", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 5 as int))").alias("ts"))
    table = VersionedTable(spark, scratch(spark, "dated"), "ts", "day")
    table.replace(rows)
    return table, rows


def partition_filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[plan.index("PartitionFilters"):].split("]")[0]


def test_a_refresh_that_ends_early_changes_nothing(dated):
    table, rows = dated
    table.stage(rows.limit(3))     # ended before the switch
    assert table.numbers() == [1] and table.read().count() == 100


def test_a_reader_stays_with_its_version(dated):
    table, rows = dated
    reader = table.read()
    table.replace(rows.limit(7))
    assert reader.count() == 100 and table.read().count() == 7 and table.read(1).count() == 100
    with pytest.raises(FileNotFoundError):
        table.read(9)


def test_two_refreshes_at_once_conflict(dated):
    table, rows = dated
    first, second = table.stage(rows.limit(1)), table.stage(rows.limit(2))
    table.publish(first)
    with pytest.raises(Conflict):
        table.publish(second)
    assert table.read().count() == 1


def test_single_days_are_replaced(dated, spark):
    table, rows = dated
    table.replace_days(rows.filter("id in (2, 7)").withColumn("id", F.col("id") + 1000), [DAY])
    assert table.read().count() == 82 and table.read().filter("id >= 1000").count() == 2
    table.replace_days(rows.limit(0), [DAY])
    assert table.read().filter(F.to_date("ts") == DAY).isEmpty() and table.read().count() == 80
    empty = rows.limit(2).withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    table.replace_days(empty, [None])
    assert table.read().count() == 82
    table.replace_days(empty.limit(1), [None])
    assert table.read().count() == 81 and table.read_day_set([None]).count() == 1
    table.expire(keep=1)
    assert len(table.numbers()) == 1 and table.read().count() == 81


def test_day_reads_open_only_their_folders(dated, spark):
    table, _ = dated
    some = table.read_days(DAY, DAY + dt.timedelta(days=1))
    assert some.count() == 40 and some.columns == ["id", "ts"]
    assert "day" in partition_filters(some) and "2024-01-03" in partition_filters(some)
    days = spark.createDataFrame([(1, dt.datetime(2024, 1, 3))], "id int, t timestamp_ntz").filter("id = 1").select("t")
    assert table.read_days_of(days).count() == 20
    files = table._stored(table.version()).select(F.col("day"), F.input_file_name().alias("f")).distinct().groupBy("day").count()
    assert files.agg(F.max("count")).first()[0] <= 4


def same(a, b):
    a = a.select(*[F.to_json(c).alias(c) if t == "variant" else F.col(c) for c, t in a.dtypes])
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


class Changed(dict):
    """Raw tables after inserts, updates and deletes in several of them."""

    def __init__(self, raw):
        super().__init__({name: raw[name] for name in TABLES})
        pick = lambda key, n, k: F.pmod(F.xxhash64(key), F.lit(n)) == k
        orders = raw["orders"].filter(~pick("order_id", 97, 1))
        late = F.expr("created_at + interval 1 day")
        self["orders"] = orders.withColumn("created_at", F.when(pick("order_id", 89, 2), late).otherwise(F.col("created_at")))
        self["missions"] = raw["missions"].withColumn(
            "status", F.when(pick("mission_id", 83, 3), "CANCELLED").otherwise(F.col("status")))
        self["routes"] = raw["routes"].filter(~pick("route_id", 101, 4))
        self["delivery_feedback"] = raw["delivery_feedback"].withColumn(
            "comments", F.when(pick("feedback_id", 61, 5), "terrible and late").otherwise(F.col("comments")))
        extra = raw["customers"].filter(pick("customer_id", 9, 1)).withColumn("customer_id", F.concat("customer_id", F.lit("-n")))
        self["customers"] = raw["customers"].filter(~pick("customer_id", 7, 0)).unionByName(extra)
        self["depots"] = raw["depots"].withColumn("depot_name", F.concat("depot_name", F.lit(" II")))
        one_day = F.to_date("recorded_at") == dt.date(2024, 1, 9)
        self["flight_logs"] = raw["flight_logs"].filter(~(one_day & pick("flight_log_id", 3, 0)))
        self["parts_used"] = raw["parts_used"].filter(~pick("usage_id", 11, 0))


def test_a_change_set_gives_what_a_full_refresh_gives(spark, context):
    root, new = scratch(spark, "layers"), Changed(context.raw)
    refresh(spark, context.raw, root, adapter.AS_OF, adapter.LOAD_TS, adapter.TEST_LEXICON)
    changed = ("orders", "missions", "routes", "delivery_feedback", "customers", "depots", "flight_logs", "parts_used")
    sets = {n: cdc.changes(context.raw[n], new[n], [TABLES[n].key]) for n in changed}
    before = tables.Snapshot(spark, root)
    work = incremental.IncrementalRefresh(spark, root, sets, adapter.AS_OF, adapter.LOAD_TS, adapter.TEST_LEXICON).run()
    assert tables.Snapshot(spark, root).versions == before.versions      # staged, not visible
    after = work.publish()
    full = Layers(new, adapter.AS_OF, adapter.LOAD_TS, adapter.TEST_LEXICON)
    for name in full.gold:
        assert same(after["gold", name], full.gold[name]), name
    assert same(after["silver", "silver_delivery_feedback"], full.silver["silver_delivery_feedback"])
    # deleted rows stay in bronze, marked
    bronze = after["bronze", "bronze_orders"]
    gone = bronze.filter("_is_deleted")
    assert gone.count() == context.raw["orders"].count() - new["orders"].count() > 0
    assert gone.filter("_deleted_at is null").isEmpty()
    # one day of telemetry is new, the other folders are the old ones
    _, _, days = work.staged["gold/fct_flight_telemetry"]
    assert days == [dt.date(2024, 1, 9)]
    version = after.table("gold", "fct_flight_telemetry").version()
    assert len(version.writes) == 2 and version.writes[0].without == ("2024-01-09",)
    assert "gold/dim_delivery_zones" not in work.staged      # not concerned
    # the old snapshot can still be read
    assert same(before["gold", "dim_customers"], context.gold["dim_customers"])
    # the same change set again changes nothing
    again = incremental.apply_changes(spark, root, sets, adapter.AS_OF, adapter.LOAD_TS, adapter.TEST_LEXICON)
    for name in ("fct_deliveries", "kpi_delivery_performance", "dim_customers"):
        assert same(again["gold", name], full.gold[name]), name


def test_deliveries_read_only_touched_days(spark, context):
    root = scratch(spark, "layers")
    table = tables.stored_table(spark, root, "gold", "fct_deliveries")
    table.replace(context.gold["fct_deliveries"])
    days = [r[0] for r in table.read().select(F.to_date("order_created_at")).distinct().limit(2).collect()]
    plan = partition_filters(table.read_day_set(days))
    assert all(str(day) in plan for day in days)
