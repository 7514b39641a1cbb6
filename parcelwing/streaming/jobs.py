"""Continuous change application and hourly telemetry.

Both jobs write each micro-batch to a folder named after its stream and batch,
so a replayed batch overwrites its own output and nothing else. Work per batch
is proportional to the batch; the current state is derived when it is read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelwing.functions import columns as C
from parcelwing.operators import cdc
from parcelwing.plans.gold import telemetry_measures, telemetry_partials, telemetry_totals

STREAM, BATCH = "_stream", "_batch"


def _batch_writer(folder: str, stream: str | None = None):
    base = folder if stream is None else f"{folder}/{STREAM}={stream}"

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{base}/{BATCH}={batch_id}")

    return write


def _stream_name(checkpoint: str) -> str:
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def _run(stream: DataFrame, folder: str, checkpoint: str, mode: str) -> None:
    """Process what is available. Batches of different checkpoints never share a folder."""
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(_batch_writer(folder, _stream_name(checkpoint)))
        .start()
    )
    query.awaitTermination()


def change_stream(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    """Stream over a folder of change files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def apply_changes(changes: DataFrame, log: str, checkpoint: str) -> None:
    """Append all available changes to the change log, one folder per batch."""
    _run(changes, log, checkpoint, "append")


def _logged(spark: SparkSession, log: str) -> tuple[DataFrame, str]:
    """The log and its ordering column: the source version, or the batch if rows carry no version."""
    rows = spark.read.parquet(log)
    return (rows, cdc.VERSION) if cdc.VERSION in rows.columns else (rows, BATCH)


def current_state(base: DataFrame, log: str, keys: list[str], after: int = -1, upto: int | None = None) -> DataFrame:
    """The base table with the logged changes of the versions after..upto applied.

    Versions order the changes. Rows may arrive in any cut into files and batches,
    in any order, and more than once. Rows without a version are ordered by their
    batch, which must then hold one change set.
    """
    rows, order = _logged(base.sparkSession, log)
    rows = rows.filter(F.col(order) > after)
    if upto is not None:
        rows = rows.filter(F.col(order) <= upto)
    rows = rows.drop(*[c for c in (STREAM, BATCH) if c != order])
    return cdc.merge(base, cdc.net(rows, keys, order), keys)


def last_batch(spark: SparkSession, log: str) -> int:
    """Number of the newest batch in a change log."""
    return spark.read.parquet(log).agg(F.max(BATCH)).first()[0]


def settled_version(spark: SparkSession, log: str, after: int = 0) -> int:
    """The last version up to which none is missing from the log, counted from `after`.

    One row a version passes through the window. A version of several files counts
    as there with its first one, so leave versions that may be incomplete to a
    later call.
    """
    rows, _ = _logged(spark, log)
    seen = rows.filter(F.col(cdc.VERSION) > after).select(F.col(cdc.VERSION).alias("v")).distinct()
    numbered = seen.selectExpr("v", f"v - {after} - row_number() OVER (ORDER BY v) AS missing")
    found = numbered.filter("missing = 0").agg(F.max("v")).first()[0]
    return after if found is None else found


def stale_changes(spark: SparkSession, log: str, after: int) -> DataFrame:
    """Rows per version that a base as of `after` holds already: replays, which the state leaves out."""
    rows, order = _logged(spark, log)
    return rows.filter(F.col(order) <= after).groupBy(order).agg(F.count(F.lit(1)).alias("rows"))


def compact(base: DataFrame, log: str, keys: list[str], path: str, after: int = -1, upto: int | None = None) -> DataFrame:
    """Write the state as of version `upto` (default: all that is logged) as a new base.

    Read the state from then on with `after` set to that version: earlier rows
    of the log, also those that are replayed later, are left out.
    """
    current_state(base, log, keys, after, upto).write.mode("errorifexists").parquet(path)
    return base.sparkSession.read.schema(base.schema).parquet(path)


def hourly_telemetry(flights: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Streaming form of the hourly telemetry fact, for consumers that want each hour once, when it is closed.

    Rows that come later than `lateness` are left out. Event time is cast to an instant, because watermarks accept no zone-less
    timestamps; the hour is cast back.
    """
    timed = flights.withColumn("_instant", F.col("recorded_at").cast("timestamp")).withWatermark("_instant", lateness)
    hours = timed.groupBy("aircraft_id", F.window("_instant", "1 hour").alias("_w")).agg(*telemetry_measures())
    hour = F.col("_w.start").cast("timestamp_ntz").alias("hour_bucket")
    return hours.select("aircraft_id", hour, *[c for c in hours.columns if c not in ("aircraft_id", "_w")])


def _partial_writer(folder: str, stream: str):
    write = _batch_writer(folder, stream)

    def partial(rows: DataFrame, batch_id: int) -> None:
        hour = C.trunc_to("hour", "recorded_at").alias("hour_bucket")
        write(rows.groupBy("aircraft_id", hour).agg(*telemetry_partials()), batch_id)

    return partial


def run_hourly_telemetry(flights: DataFrame, folder: str, checkpoint: str) -> None:
    """Write partial sums of the hours in each batch.

    Partial sums need no state and no watermark: a row counts whenever it
    arrives, and a batch that is done again replaces its own sums.
    """
    name = _stream_name(checkpoint)
    query = (flights.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
             .foreachBatch(_partial_writer(folder, name)).start())
    query.awaitTermination()


def read_hourly_telemetry(spark: SparkSession, folder: str) -> DataFrame:
    """The hourly fact from the partial sums of all batches, by fixed-width hash aggregates."""
    return spark.read.parquet(folder).groupBy("aircraft_id", "hour_bucket").agg(*telemetry_totals())


def late_hours(spark: SparkSession, folder: str, hours: int = 1) -> DataFrame:
    """Points that came after a batch whose newest hour lies more than `hours` later: per hour and batch.

    They are in the fact; whoever has passed its hours on corrects these. Batches
    are few, so their newest hours are put in order by one window.
    """
    rows = spark.read.parquet(folder)
    newest = rows.groupBy(STREAM, BATCH).agg(F.max("hour_bucket").alias("_newest"))
    before = Window.partitionBy(STREAM).orderBy(BATCH).rowsBetween(Window.unboundedPreceding, -1)
    seen = newest.withColumn("_seen", F.max("_newest").over(before)).drop("_newest")
    late = rows.join(seen, [STREAM, BATCH]).filter(F.col("hour_bucket") < F.col("_seen") - F.expr(f"INTERVAL {hours} HOURS"))
    return late.groupBy("hour_bucket", F.col(BATCH).alias("batch")).agg(F.sum("telemetry_points").alias("late_points"))


def deduplicated(stream: DataFrame, keys: list[str], ts: str, lateness: str = "1 hour") -> DataFrame:
    """Drop repeated keys that arrive within the allowed lateness."""
    timed = stream.withColumn("_instant", F.col(ts).cast("timestamp")).withWatermark("_instant", lateness)
    return timed.dropDuplicatesWithinWatermark(keys).drop("_instant")
