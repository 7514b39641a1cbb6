"""Row filters of the report layer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwing.functions import columns as C


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where all the columns are present."""
    return df.dropna(subset=list(columns))


def between_days(df: DataFrame, ts: str, start: dt.date | None, end: dt.date | None) -> DataFrame:
    """Rows of the calendar days start..end, both included.

    The bounds are half-open timestamps, so they reach the file scan as pushed
    filters instead of hiding the column in a date conversion.
    """
    if start is not None:
        df = df.filter(F.col(ts) >= C.moment(f"{start} 00:00:00"))
    if end is not None:
        df = df.filter(F.col(ts) < C.moment(f"{end + dt.timedelta(days=1)} 00:00:00"))
    return df


def latest(df: DataFrame, ts: str) -> DataFrame:
    """Rows that carry the newest value of a column."""
    return df.filter(F.col(ts) == df.agg(F.max(ts)).scalar())


def fleet_of_depot(aircraft: DataFrame, depots: DataFrame, depot_name: str | None) -> DataFrame:
    """Aircraft stationed at the named depot; all when no depot is chosen."""
    if depot_name is None:
        return aircraft
    chosen = depots.filter(F.col("depot_name") == depot_name).select("depot_id")
    return aircraft.join(chosen, "depot_id", "left_semi")


def flown_by(deliveries: DataFrame, fleet: DataFrame) -> DataFrame:
    """Deliveries whose aircraft belongs to the fleet."""
    return deliveries.join(fleet.select("aircraft_id"), "aircraft_id", "left_semi")
