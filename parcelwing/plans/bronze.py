"""Bronze layer: business columns plus load metadata, one table per source."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwing.functions import columns as C
from parcelwing.sources.schemas import TABLES, source_tag


def load_columns(table: str, load_ts: dt.datetime | None = None) -> dict[str, Column]:
    """What bronze adds to a row: when and from where it was loaded."""
    loaded = C.moment(load_ts) if load_ts else F.current_timestamp().cast("timestamp_ntz")
    return {"_loaded_at": loaded, "_source_file": F.lit(source_tag(table)), "_dbt_loaded_at": loaded}


def to_bronze(df: DataFrame, table: str, load_ts: dt.datetime | None = None) -> DataFrame:
    return df.select(*TABLES[table].names, *[column.alias(name) for name, column in load_columns(table, load_ts).items()])


def live(df: DataFrame) -> DataFrame:
    """The rows that the layers above see: those not marked as deleted."""
    if "_is_deleted" not in df.columns:
        return df
    return df.filter(~F.coalesce("_is_deleted", F.lit(False))).drop("_is_deleted", "_deleted_at")
