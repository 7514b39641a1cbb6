"""Table input and output: typed scans, appends, full refreshes, views, inventories."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwing.sources.schemas import TABLES
from parcelwing.sources.versions import Files, VersionedTable

# layout of the tables that grow with time, so date filters prune folders
PARTITION_COLUMNS = {"bronze_flight_logs": ("recorded_at", "recorded_date"),
                     "fct_deliveries": ("order_created_at", "order_date"),
                     "fct_flight_telemetry": ("hour_bucket", "bucket_date")}
SNAPSHOTS = "_snapshots"


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def read_raw(spark: SparkSession, name: str, root: str) -> DataFrame:
    """Typed scan of a raw table."""
    return spark.read.schema(TABLES[name].schema).parquet(table_path(root, "raw", name))


def read_typed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Scan of one Parquet table with a declared schema."""
    return spark.read.schema(schema).parquet(path)


def literal_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """Inline relation from a handful of literal rows."""
    return spark.createDataFrame([tuple(row) for row in rows], schema)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def stored_table(spark: SparkSession, root: str, layer: str, name: str) -> VersionedTable:
    """The versions of a table; time-series tables are laid out by day."""
    return VersionedTable(spark, table_path(root, layer, name), *PARTITION_COLUMNS.get(name, ()))


def publish_table(df: DataFrame, root: str, layer: str, name: str) -> str:
    """Rebuild a table from its query as a new version; readers of the old one keep it."""
    table = stored_table(df.sparkSession, root, layer, name)
    table.replace(df)
    return table.path


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Publish a lazily evaluated view and return it read back by name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def read_table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """The newest version of a table, as of this call."""
    return stored_table(spark, root, layer, name).read()


def read_gold(spark: SparkSession, name: str, root: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """A gold table; of one that is laid out by day, only the folders of the days start..end."""
    table = stored_table(spark, root, "gold", name)
    return table.read() if start is None and end is None else table.read_days(start, end)


class Snapshot(Mapping):
    """One version of every table, as a refresh left them together: (layer, name) -> DataFrame."""

    def __init__(self, spark: SparkSession, root: str, number: int | None = None):
        files = Files(spark, root)
        known = [int(n[:-5]) for n in files.names(f"{root}/{SNAPSHOTS}") if n.endswith(".json")]
        if not known or number is not None and number not in known:
            raise FileNotFoundError(f"{root} has no snapshot {'' if number is None else number}")
        self.spark, self.root, self.number = spark, root, known[-1] if number is None else number
        self.versions = json.loads(files.read(snapshot_file(root, self.number)))

    def __iter__(self):
        return (tuple(key.split("/")) for key in self.versions)

    def __len__(self) -> int:
        return len(self.versions)

    def table(self, layer: str, name: str) -> VersionedTable:
        return stored_table(self.spark, self.root, layer, name)

    def __getitem__(self, key: tuple[str, str]) -> DataFrame:
        return self.table(*key).read(self.versions["/".join(key)])

    def days(self, layer: str, name: str, start: dt.date | None, end: dt.date | None) -> DataFrame:
        return self.table(layer, name).read_days(start, end, self.versions[f"{layer}/{name}"])


def snapshot_file(root: str, number: int) -> str:
    return f"{root}/{SNAPSHOTS}/{number:010d}.json"


def publish_snapshot(spark: SparkSession, root: str, versions: dict[str, int]) -> int:
    """Name the versions that belong together; tables that are not named keep theirs."""
    files = Files(spark, root)
    known = [int(n[:-5]) for n in files.names(f"{root}/{SNAPSHOTS}") if n.endswith(".json")]
    held = json.loads(files.read(snapshot_file(root, known[-1]))) if known else {}
    number = known[-1] + 1 if known else 1
    files.create(snapshot_file(root, number), json.dumps(held | versions))
    return number


def layer_inventory(spark: SparkSession, prefix: str = "") -> DataFrame:
    """Published relations of each layer and the rows they hold.

    Relation names come from the session catalog and start with the layer
    (bronze_orders, silver_orders, gold_fct_deliveries) after `prefix`.
    """
    names = [t.name for t in spark.catalog.listTables(pattern=f"{prefix}*")]
    counted = [
        spark.table(name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name[len(prefix):].split("_")[0]).alias("layer"), "n")
        for name in names
    ]
    listed = reduce(lambda a, b: a.unionByName(b), counted)
    return listed.groupBy("layer").agg(F.count(F.lit(1)).alias("relations"), F.sum("n").alias("total_rows"))
