"""Table output, full refresh, shared folder and streaming jobs."""

import pytest
from pyspark.sql import functions as F

from parcelwing import session
from parcelwing.operators import cdc
from parcelwing.plans.bronze import to_bronze
from parcelwing.plans.layers import refresh
from parcelwing.plans.silver import flight_logs
from parcelwing.sources import adapter, tables
from parcelwing.sources.schemas import FOREIGN_KEYS, TABLES
from parcelwing.streaming import jobs

FOLDER = "/root/testdata/sf0.001"


def test_data_model_is_consistent():
    assert len(TABLES) == 16 and len(FOREIGN_KEYS) == 14
    for table in TABLES.values():
        assert table.key == table.names[0]
    for child, column, parent in FOREIGN_KEYS:
        assert column in TABLES[child].names and parent in TABLES


class Session:
    """Stand-in for a session with the given master and shared folder."""

    def __init__(self, master, folder=None):
        self.conf = self
        self.sparkContext = self
        self.master, self.folder, self.applicationId = master, folder, f"app-{master}"

    def get(self, key, default):
        return self.folder if key == "spark.checkpoint.dir" else default


def test_shared_folder_follows_the_cluster_setting():
    assert session.scratch(Session("spark://host:7077", "/shared/run"), "x").startswith("/shared/run/x-")
    assert session.shared_folder(Session("local[2]", "/shared/run")) == "/shared/run"


def test_only_a_local_master_may_use_its_own_folder():
    local = Session("local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)
    with pytest.raises(ValueError):
        session.shared_folder(Session("spark://host:7077"))


def test_refresh_writes_all_layers_and_equals_the_lazy_layers(spark, context):
    root = session.scratch(spark, "refresh")
    built = refresh(spark, context.raw, root, adapter.AS_OF, adapter.LOAD_TS, adapter.TEST_LEXICON)
    for name in ("kpi_delivery_performance", "dim_customers", "fct_flight_telemetry"):
        written, lazy = tables.read_gold(spark, name, root), context.gold[name]
        assert written.columns == lazy.columns
        assert written.exceptAll(lazy).isEmpty() and lazy.exceptAll(written).isEmpty()
    assert built.gold["dim_depots"].count() == context.gold["dim_depots"].count()
    stored = spark.read.parquet(tables.table_path(root, "gold", "fct_flight_telemetry"))
    plan = stored.filter("bucket_date = date'2024-01-05'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket_date" in plan


def test_raw_scan_uses_the_declared_schema(spark, context):
    root = session.scratch(spark, "raw")
    tables.append(context.raw["depots"], tables.table_path(root, "raw", "depots"))
    tables.append(context.raw["depots"], tables.table_path(root, "raw", "depots"))
    scan = tables.read_raw(spark, "depots", root)
    assert scan.columns == TABLES["depots"].names and scan.count() == 2 * context.raw["depots"].count()


def test_changes_arriving_in_batches_give_the_last_version(spark):
    v0, v1, v2 = adapter.customer_versions(spark, FOLDER)
    keys = ["customer_id"]
    inbox, log, checkpoint = (session.scratch(spark, n) for n in ("inbox", "log", "checkpoint"))
    first = cdc.changes(v0, v1, keys)
    for part in range(3):  # one file per third of the keys, one batch per file
        first.filter(F.pmod(F.xxhash64("customer_id"), F.lit(3)) == part).coalesce(1).write.mode("append").parquet(inbox)
    stream = lambda: jobs.change_stream(spark, inbox, first.schema, files_per_batch=1)
    jobs.apply_changes(stream(), log, checkpoint)
    assert jobs.current_state(v0, log, keys).exceptAll(v1).isEmpty()
    jobs.apply_changes(stream(), log, checkpoint)  # nothing new: nothing changes
    assert v1.exceptAll(jobs.current_state(v0, log, keys)).isEmpty()
    done = jobs.last_batch(spark, log)
    base = jobs.compact(v0, log, keys, session.scratch(spark, "base"))
    cdc.changes(v1, v2, keys).write.mode("append").parquet(inbox)
    jobs.apply_changes(stream(), log, checkpoint)
    final = jobs.current_state(base, log, keys, after=done)
    assert final.exceptAll(v2).isEmpty() and v2.exceptAll(final).isEmpty()


def test_a_replayed_batch_overwrites_itself(spark):
    v0, v1, _ = adapter.customer_versions(spark, FOLDER)
    log, changes = session.scratch(spark, "log"), cdc.changes(v0, v1, ["customer_id"])
    write = jobs._batch_writer(log)
    for _ in range(2):
        write(changes, 0)
    assert spark.read.parquet(log).count() == changes.count()


def test_hourly_stream_equals_batch_over_several_batches(spark, context):
    """Files are read oldest first, so no row is later than the watermark allows."""
    inbox = session.scratch(spark, "events")
    events = context.table("events").orderBy("ts")
    for low, high in (("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2024-02-01")):
        events.filter((F.col("ts") >= low) & (F.col("ts") < high)).coalesce(1).write.mode("append").parquet(f"{inbox}/events.parquet")

    class Inbox(adapter.StreamingTables):
        def _open(self, name):
            schema = adapter.SOURCE_SCHEMAS[name]
            return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{self.folder}/{name}.parquet")

    raw = Inbox(spark, inbox)["flight_logs"]
    flights = flight_logs({"flight_logs": to_bronze(raw, "flight_logs", adapter.LOAD_TS)}, adapter.AS_OF)
    folder = session.scratch(spark, "out")
    jobs.run_hourly_telemetry(flights, folder, session.scratch(spark, "checkpoint"))
    streamed, batch = jobs.read_hourly_telemetry(spark, folder), context.gold["fct_flight_telemetry"]
    streamed = streamed.select(batch.columns)
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_stream_deduplication_drops_repeats(spark, context):
    inbox, out = session.scratch(spark, "dup"), session.scratch(spark, "out")
    events = context.table("events")
    events.unionByName(events).write.parquet(inbox)
    stream = spark.readStream.schema(events.schema).parquet(inbox)
    jobs._run(jobs.deduplicated(stream, ["event_id"], "ts"), out, session.scratch(spark, "checkpoint"), "append")
    assert spark.read.parquet(out).count() == events.count()


def test_a_backfill_in_reverse_order_equals_the_batch(spark, context):
    """Partial sums take rows whenever they come; late ones are told by hour and batch."""
    inbox, events = session.scratch(spark, "events"), context.table("events")
    cuts = ("2024-01-01", "2024-01-11", "2024-01-21", "2024-02-01")
    path, folder, checkpoint = f"{inbox}/events.parquet", session.scratch(spark, "out"), session.scratch(spark, "checkpoint")
    for low, high in reversed(list(zip(cuts, cuts[1:]))):
        events.filter((F.col("ts") >= low) & (F.col("ts") < high)).write.mode("append").parquet(path)
        raw = adapter.StreamingTables(spark, inbox)["flight_logs"]
        flights = flight_logs({"flight_logs": to_bronze(raw, "flight_logs", adapter.LOAD_TS)}, adapter.AS_OF)
        jobs.run_hourly_telemetry(flights, folder, checkpoint)
    streamed, batch = jobs.read_hourly_telemetry(spark, folder), context.gold["fct_flight_telemetry"]
    streamed = streamed.select(batch.columns)
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()
    late = jobs.late_hours(spark, folder).agg(F.sum("late_points"), F.max("batch")).first()
    early = batch.filter("hour_bucket < timestamp_ntz'2024-01-21'").agg(F.sum("telemetry_points")).first()[0]
    assert 0 < late[0] <= early and late[1] == 2
    assert "SortAggregate" not in streamed._jdf.queryExecution().executedPlan().toString()
