"""Change sets through the layers: only what a change touches is built again.

A change set holds net changes of raw tables. Bronze rows are merged; deleted
ones stay and are marked, and the layers above do not see them. The keys in the
old and new images, followed to the parent that a gold table is built around,
select the gold rows to build; their days select the folders and the KPI rows to
replace. Other rows are taken from the stored tables, and folders of other days
stay where they are, unread. The result equals a full refresh from the changed
raw tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwing import rules
from parcelwing.functions.text import Lexicon
from parcelwing.operators import cdc
from parcelwing.plans import gold, silver
from parcelwing.plans.bronze import live, load_columns
from parcelwing.plans.layers import FEEDBACK, Layers
from parcelwing.session import scratch
from parcelwing.sources import tables
from parcelwing.sources.schemas import TABLES
from parcelwing.sources.versions import Staged, VersionedTable

Days = list[dt.date | None]

# gold table: its key, and the tables in which a column holds that key
KEYED = {
    "dim_aircraft": ("aircraft_id", {"aircraft": "aircraft_id", "missions": "aircraft_id", "maintenance_logs": "aircraft_id"}),
    "dim_customers": ("customer_id", {"customers": "customer_id", "orders": "customer_id", "delivery_feedback": "customer_id"}),
    "dim_delivery_zones": ("zone_id", {"delivery_zones": "zone_id"}),
    "dim_depots": ("depot_id", {"depots": "depot_id", "aircraft": "depot_id", "parts_inventory": "depot_id"}),
    "fct_deliveries": ("order_id", {"orders": "order_id", "missions": "order_id", "delivery_feedback": "order_id"}),
    "fct_maintenance": ("log_id", {"maintenance_logs": "log_id", "parts_used": "log_id"}),
}
# tables that reach a gold key through a parent that holds it: (parent, column that both have)
THROUGH = {"dim_aircraft": {"depots": ("aircraft", "depot_id")}, "fct_deliveries": {"routes": ("missions", "mission_id")}}
# gold tables that follow the reference time: all their rows change with it
TIMED = ("dim_aircraft",)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


class _Touched(Mapping):
    """Silver tables, cut to the touched keys where they hold the key or reach it through a parent."""

    def __init__(self, silver_tables: Mapping[str, DataFrame], model: str, touched: DataFrame):
        self.tables, self.touched = silver_tables, touched
        self.crowded = getattr(silver_tables, "crowded", {})
        self.key, self.columns = KEYED[model]
        self.through = THROUGH.get(model, {})

    def __iter__(self):
        return iter(self.tables)

    def __len__(self) -> int:
        return len(self.tables)

    def __getitem__(self, name: str) -> DataFrame:
        rows, table = self.tables[name], name.removeprefix("silver_")
        if table in self.columns:
            column = self.columns[table]
            return rows.join(self.touched.withColumnRenamed(self.key, column), column, "left_semi")
        if table in self.through:
            parent, column = self.through[table]
            return rows.join(self[f"silver_{parent}"].select(column), column, "left_semi")
        return rows


class IncrementalRefresh:
    """Stages the tables that a change set touches; `publish` makes them visible together."""

    def __init__(self, spark: SparkSession, root: str, changes: Mapping[str, DataFrame], as_of: dt.datetime,
                 load_ts: dt.datetime, lexicon: Lexicon = rules.SENTIMENT_LEXICON):
        self.spark, self.root, self.as_of, self.load_ts = spark, root, as_of, load_ts
        self.before = tables.Snapshot(spark, root)
        self.changes = {name: self._kept(rows, f"changes-{name}") for name, rows in changes.items()}
        self.staged: dict[str, tuple[VersionedTable, Staged, Days | None]] = {}
        self.layers = Layers({}, as_of, load_ts, lexicon)
        scored = self.before.table("silver", FEEDBACK).version(self.before.versions[f"silver/{FEEDBACK}"])
        self.layers.silver.crowded = scored.notes.get("crowded", {})
        for name in TABLES:
            self.layers.bronze.replace(name, self.before["bronze", f"bronze_{name}"])

    def _kept(self, rows: DataFrame, purpose: str) -> DataFrame:
        """Rows that several tables ask for, written once."""
        path = scratch(self.spark, purpose)
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _stage(self, layer: str, name: str, rows: DataFrame, days: Days | None = None) -> DataFrame:
        table = self.before.table(layer, name)
        done = table.stage(rows, {"as_of": str(self.as_of), "crowded": self.layers.silver.crowded})
        self.staged[f"{layer}/{name}"] = (table, done, days)
        return table.read_staged(done)

    def _stored_days(self, layer: str, name: str, days: Days) -> DataFrame:
        return self.before.table(layer, name).read_day_set(days, self.before.versions[f"{layer}/{name}"])

    @staticmethod
    def _days(rows: DataFrame, ts: str) -> Days:
        """Different calendar days of a column: no more than the calendar has."""
        return [r[0] for r in rows.select(F.to_date(ts)).distinct().collect()]

    # --- bronze and silver ------------------------------------------------------
    def _merge(self, name: str) -> None:
        key, stored = TABLES[name].key, f"bronze_{name}"
        arriving = self.changes[name].withColumns(load_columns(name, self.load_ts))
        if stored in tables.PARTITION_COLUMNS:
            days = self._days(arriving, tables.PARTITION_COLUMNS[stored][0])
            merged = cdc.soft_merge(self._stored_days("bronze", stored, days), arriving, [key], self.load_ts)
            self._stage("bronze", stored, merged, days)
        else:
            merged = cdc.soft_merge(self.layers.bronze[name], arriving, [key], self.load_ts)
            self.layers.bronze.replace(name, self._stage("bronze", stored, merged))

    def _score(self) -> None:
        """Feedback is scored where it changed, and taken as stored elsewhere."""
        held = self.before["silver", FEEDBACK]
        if "delivery_feedback" in self.changes:
            ids = self.changes["delivery_feedback"].select("feedback_id").distinct()
            fresh = live(self.layers.bronze["delivery_feedback"]).join(ids, "feedback_id", "left_semi")
            scored = silver.delivery_feedback({"delivery_feedback": fresh}, self.as_of, self.layers.lexicon)
            held = self._stage("silver", FEEDBACK, held.join(ids, "feedback_id", "left_anti").unionByName(scored))
        self.layers.silver.replace(FEEDBACK, held)

    # --- gold -------------------------------------------------------------------
    def _touched(self, model: str) -> DataFrame | None:
        """Keys of a gold table that any old or new image names; None if no changed table concerns it."""
        key, columns = KEYED[model]
        found = [self.changes[t].select(F.col(c).alias(key)) for t, c in columns.items() if t in self.changes]
        for table, (parent, column) in THROUGH.get(model, {}).items():
            if table in self.changes:
                named = self.changes[table].select(column).distinct()
                holders = self.layers.bronze[parent].join(named, column, "left_semi")
                found.append(holders.select(F.col(columns[parent]).alias(key)))
        return self._kept(_union(found).dropna().distinct(), f"touched-{model}") if found else None

    def _rebuild(self, model: str) -> None:
        """Touched rows anew, all others as they are stored."""
        timed = model in TIMED and self.before.table("gold", model).version(
            self.before.versions[f"gold/{model}"]).notes.get("as_of") != str(self.as_of)
        if timed:
            self._stage("gold", model, gold.FROM_SILVER[model](self.layers.silver, self.as_of))
            return
        touched, key = self._touched(model), KEYED[model][0]
        if touched is None:
            return
        built = gold.FROM_SILVER[model](_Touched(self.layers.silver, model, touched), self.as_of)
        held = self.before["gold", model].join(touched, key, "left_anti")
        self._stage("gold", model, held.unionByName(built))

    def _rebuild_deliveries(self) -> None:
        """Orders that are touched, and the whole days that they were or are on."""
        model = "fct_deliveries"
        touched = self._touched(model)
        if touched is None:
            return
        on = [self.layers.bronze["orders"].join(touched, "order_id", "left_semi").select("created_at")]
        if "orders" in self.changes:
            on.append(self.changes["orders"].select("created_at"))
        days = self._days(_union(on), "created_at")
        built = gold.fct_deliveries(_Touched(self.layers.silver, model, touched), self.as_of)
        held = self._stored_days("gold", model, days).join(touched, "order_id", "left_anti")
        facts = self._stage("gold", model, held.unionByName(built), days)
        kpi = "kpi_delivery_performance"
        dated = [day for day in days if day is not None]
        day = F.to_date("report_date")
        other = F.when(day.isNull(), F.lit(None not in days)).otherwise(~day.isin(dated) if dated else F.lit(True))
        self._stage("gold", kpi, self.before["gold", kpi].filter(other).unionByName(
            gold.kpi_delivery_performance({"fct_deliveries": facts}, self.as_of)))

    def _rebuild_telemetry(self) -> None:
        if "flight_logs" not in self.changes:
            return
        table, staged, days = self.staged["bronze/bronze_flight_logs"]
        points = silver.flight_logs({"flight_logs": live(table.read_staged(staged))}, self.as_of)
        facts = gold.fct_flight_telemetry({"silver_flight_logs": points}, self.as_of)
        self._stage("gold", "fct_flight_telemetry", facts, days)

    def run(self) -> IncrementalRefresh:
        for name in self.changes:
            self._merge(name)
        self._score()
        for model in KEYED:
            if model != "fct_deliveries":
                self._rebuild(model)
        self._rebuild_deliveries()
        self._rebuild_telemetry()
        return self

    def publish(self) -> tables.Snapshot:
        versions = {key: table.publish(done, days).number for key, (table, done, days) in self.staged.items()}
        number = tables.publish_snapshot(self.spark, self.root, versions)
        return tables.Snapshot(self.spark, self.root, number)


def apply_changes(spark: SparkSession, root: str, changes: Mapping[str, DataFrame], as_of: dt.datetime, load_ts: dt.datetime,
                  lexicon: Lexicon = rules.SENTIMENT_LEXICON) -> tables.Snapshot:
    """Bring the tables below `root` up to a change set: raw table -> net change rows of `cdc.changes` or `cdc.net`."""
    return IncrementalRefresh(spark, root, changes, as_of, load_ts, lexicon).run().publish()
