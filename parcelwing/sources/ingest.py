"""Files that land from outside, read into the raw tables.

Types are declared, never inferred. Every row gets the time of loading and the
file it came from, a missing value gets its column's default, and rows that do
not fit the declared types are set aside with their text instead of failing the
load or becoming nulls.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from parcelwing.functions import columns as C
from parcelwing.sources.schemas import TABLES

LOADED_AT, SOURCE_FILE, CORRUPT = "_loaded_at", "_source_file", "_corrupt_record"
MOMENT = "yyyy-MM-dd['T'][' ']HH:mm:ss[.SSSSSS][.SSS]"
PARSERS = {"csv": F.from_csv, "json": F.from_json}

# fixed values: defaults of the raw data model
DEFAULTS: dict[str, dict[str, object]] = {
    "orders": {"priority": "STANDARD"},
    "delivery_zones": {"is_active": True},
    "aircraft": {"total_flight_hours": 0.0},
    "parts_inventory": {"quantity_on_hand": 0, "reorder_level": 0},
}


def read_landed(spark: SparkSession, path: str, columns: str, form: str = "json", load_ts: dt.datetime | None = None,
                defaults: Mapping[str, object] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, rows set aside) of the files below `path`, as `columns` declares them.

    The first holds the declared columns, `defaults` where a value is missing,
    _loaded_at and _source_file. The second holds each row's text with the same
    two columns. A row of CSV or JSON is a line; CSV has no header and the
    declared order. Lines are parsed whole whatever is selected later, so the
    same ones are always set aside. Formats that carry their own types have
    nothing to set aside: a file with other types ends the load.
    """
    schema = StructType.fromDDL(columns)
    loaded = C.moment(load_ts) if load_ts else F.current_timestamp().cast("timestamp_ntz")
    told = [loaded.alias(LOADED_AT), F.col("_metadata.file_path").alias(SOURCE_FILE)]
    filled = {
        name: F.coalesce(F.col(name), F.lit(value).cast(schema[name].dataType)) for name, value in (defaults or {}).items()}
    if form not in PARSERS:
        rows = spark.read.schema(schema).format(form).load(path).select("*", *told).withColumns(filled)
        return rows, rows.limit(0).select(F.lit("").alias(CORRUPT), LOADED_AT, SOURCE_FILE)
    whole = StructType([*schema.fields, StructField(CORRUPT, StringType())]).simpleString()[len("struct<"):-1]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "timestampNTZFormat": MOMENT}
    lines = spark.read.text(path).select("value", *told).filter("value <> ''")
    rows = lines.select(PARSERS[form]("value", whole.replace(":", " "), options).alias("_row"), "value", LOADED_AT, SOURCE_FILE)
    unfit = F.col("_row").isNull() | F.col(f"_row.{CORRUPT}").isNotNull()
    good = rows.filter(~unfit).select(*[F.col(f"_row.{c}").alias(c) for c in schema.names], LOADED_AT, SOURCE_FILE)
    return good.withColumns(filled), rows.filter(unfit).select(F.col("value").alias(CORRUPT), LOADED_AT, SOURCE_FILE)


class LandedTables(Mapping):
    """The sixteen raw tables from files below `root`/<table>, as a refresh takes them."""

    def __init__(self, spark: SparkSession, root: str, form: str = "json", load_ts: dt.datetime | None = None):
        self.spark, self.root, self.form, self.load_ts = spark, root.rstrip("/"), form, load_ts

    def _read(self, name: str) -> tuple[DataFrame, DataFrame]:
        if name not in TABLES:
            raise KeyError(name)
        columns = TABLES[name].columns
        return read_landed(self.spark, f"{self.root}/{name}", columns, self.form, self.load_ts, DEFAULTS.get(name))

    def __getitem__(self, name: str) -> DataFrame:
        return self._read(name)[0]

    def __iter__(self) -> Iterator[str]:
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)

    def set_aside(self, name: str) -> DataFrame:
        """Rows of a table's files that do not fit its declared types."""
        return self._read(name)[1]
