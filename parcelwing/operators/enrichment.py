"""Joins and rules that enrich entities: zones, weather, parts named in texts, stock risk."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from functools import partial

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwing import rules
from parcelwing.functions import columns as C
from parcelwing.functions.text import name_tokens, sentences

FINER = 2        # levels below the one whose cells hold a whole bounding box
FINEST = 20      # levels of the cell tree: the finest cells are about 40 m wide


def _cell(value: Column, level: Column) -> Column:
    """Number of the cell that holds a coordinate, at a level with 2**level cells around the earth."""
    return F.floor(value * F.pow(F.lit(2.0), level) / 360.0)


def _around(column: Column, level: Column) -> Column:
    """Cell column with the 180th meridian joined up."""
    return F.pmod(column, F.pow(F.lit(2.0), level).cast("bigint"))


def _rows(center: Column, half: Column, level: Column) -> Column:
    """Numbers of all cell rows that the latitudes center +- half touch."""
    return F.sequence(_cell(center - half, level), _cell(center + half, level))


def _columns(center: Column, half: Column, level: Column) -> Column:
    """Numbers of all cell columns that the longitudes center +- half touch, each once around the earth."""
    low, high = _cell(center - half, level), _cell(center + half, level)
    return F.sequence(low, F.least(high, low + F.pow(F.lit(2.0), level).cast("bigint") - 1))


def undominated_zones(zones: DataFrame) -> DataFrame:
    """Zones that can be nearest to some point: of one spot, those wider than every zone with a smaller id."""
    earlier = Window.partitionBy("center_lat", "center_lon").orderBy("zone_id").rowsBetween(Window.unboundedPreceding, -1)
    wider = zones.withColumn("_wider", F.max("radius_km").over(earlier))
    return wider.filter(F.col("_wider").isNull() | (F.col("radius_km") > F.col("_wider"))).drop("_wider")


def zone_cells(zones: DataFrame) -> DataFrame:
    """Zones under the cells of a tree: each at a level whose cells are a fourth to a half of its bounding box.

    So a zone touches 36 cells at most, whatever its size, small zones in a
    crowded city lie in small cells, and few points meet a zone they are not near.
    """
    lat_half = F.col("radius_km") / (rules.EARTH_RADIUS_KM * F.radians(F.lit(1.0))) * 1.001
    edge = F.abs("center_lat") + lat_half
    lon_half = F.when(edge >= 89.9, F.lit(180.0)).otherwise(lat_half / F.cos(F.radians(edge)))
    sized = undominated_zones(zones.select("zone_id", "center_lat", "center_lon", "radius_km")).withColumns(
        {"_lat_half": lat_half, "_lon_half": lon_half})
    widest = F.greatest("_lat_half", "_lon_half", F.lit(1e-9)) * 2
    level = F.greatest(F.lit(0), F.least(F.lit(FINEST), F.floor(F.log2(F.lit(360.0) / widest)).cast("int") + FINER))
    placed = sized.withColumn("_level", level)
    rows = placed.withColumn("_y", F.explode(_rows(F.col("center_lat"), F.col("_lat_half"), F.col("_level"))))
    cells = rows.withColumn("_column", F.explode(_columns(F.col("center_lon"), F.col("_lon_half"), F.col("_level"))))
    return cells.withColumn("_x", _around(F.col("_column"), F.col("_level"))).drop("_column", "_lon_half")


def zone_assignment(orders: DataFrame, zones: DataFrame) -> DataFrame:
    """Each order with the nearest delivery zone whose circle holds its drop-off point, null if none does.

    Both sides meet on cells of a tree, so the join is an equi join and never
    looks at far pairs: an order is listed under its own cell at each level that
    has zones, at most 21. A city with very many orders is split by Spark's
    handling of skewed joins, which an inner join allows on either side. The
    nearest zone is a running minimum combined before the shuffle.
    """
    placed = zone_cells(zones)
    levels = placed.agg(F.collect_set("_level")).scalar()
    points = orders.select("order_id", "dropoff_lat", "dropoff_lon").withColumn("_level", F.explode(levels))
    points = points.select(
        "order_id", "dropoff_lat", "dropoff_lon", "_level", _cell(F.col("dropoff_lat"), F.col("_level")).alias("_y"),
        _around(_cell(F.col("dropoff_lon"), F.col("_level")), F.col("_level")).alias("_x"))
    km = C.round_half_up(C.haversine_km("dropoff_lat", "dropoff_lon", "center_lat", "center_lon"), 6)
    near = F.abs(F.col("dropoff_lat") - F.col("center_lat")) <= F.col("_lat_half")
    inside = points.join(placed, ["_level", "_y", "_x"]).filter(near).withColumn("distance_km", km).filter("distance_km <= radius_km")
    nearest = inside.groupBy("order_id").agg(F.min(F.struct("distance_km", "zone_id")).alias("_best"))
    return orders.select("order_id").join(nearest, "order_id", "left").select(
        "order_id", "_best.zone_id", "_best.distance_km")


def weather_at_flight(flights: DataFrame, weather: DataFrame) -> DataFrame:
    """Worst weather of the station and hour for each aircraft's flying hours.

    Both sides are aggregated to one row per hour before they meet, so no hour
    multiplies its readings with its pings.
    """
    rank = F.array_position(F.array(*[F.lit(s) for s in rules.WEATHER_SEVERITIES]), F.col("weather_severity"))
    hourly = weather.groupBy("station_id", C.trunc_to("hour", "recorded_at").alias("hour_bucket")).agg(
        F.max(rank).cast("int").alias("_worst"),
        F.min("visibility_km").alias("min_visibility_km"),
        F.max("wind_speed_kmh").alias("max_wind_kmh"),
        F.every("is_flyable").alias("is_flyable"),
    )
    flown = flights.groupBy("aircraft_id", "station_id", C.trunc_to("hour", "recorded_at").alias("hour_bucket")).agg(
        F.count(F.lit(1)).alias("telemetry_points"))
    severity = F.get(F.array(*[F.lit(s) for s in rules.WEATHER_SEVERITIES]), F.col("_worst") - 1)
    return flown.join(hourly, ["station_id", "hour_bucket"]).select(
        "aircraft_id", "station_id", "hour_bucket", "telemetry_points",
        severity.alias("worst_severity"), "min_visibility_km", "max_wind_kmh", "is_flyable",
    )


CATALOGUE_BYTES = 32 << 20     # names up to which one automaton holds the whole catalogue


def _spoken(names: dict[str, list[str]], key: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names in each text, found by one automaton in a single pass over the text."""
    automaton = ahocorasick.Automaton()
    for phrase, shown in names.items():
        automaton.add_word(phrase, shown)
    automaton.make_automaton()
    for batch in batches:
        found = [sorted({n for _, shown in automaton.iter(text) for n in shown}) for text in batch.column("_text").to_pylist()]
        held = pa.array([bool(f) for f in found])
        yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(found, pa.list_(pa.string()))],
                                         names=[key, "parts"]).filter(held)


def _padded(tokens: Column) -> Column:
    """Tokens between single blanks, so that a name is found as whole tokens only."""
    return F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))


def parts_mentioned(logs: DataFrame, parts: DataFrame, most_bytes: int = CATALOGUE_BYTES) -> DataFrame:
    """Catalogue parts named in each log's text, in alphabetical order.

    Names and texts are cut by the same rule into runs of letters and digits of
    any script. A catalogue up to `most_bytes` becomes an automaton that reads a
    text once. A larger one stays in Spark: a text's tokens meet the first tokens
    of the names, and each meeting is compared where it is, with the tokens after
    it. No text is compared with every name.
    """
    catalogue = parts.select(F.lower(F.trim("part_name")).alias("part_name")).distinct().withColumn(
        "_tokens", name_tokens("part_name")).filter(F.size("_tokens") > 0)
    kind = logs.schema["log_id"].dataType.simpleString()
    size = catalogue.agg(F.sum(F.octet_length("part_name")), F.max(F.size("_tokens"))).first()
    if (size[0] or 0) <= most_bytes:
        names: dict[str, list[str]] = {}
        for part, phrase in catalogue.select("part_name", _padded(F.col("_tokens"))).collect():
            names.setdefault(phrase, []).append(part)
        if not names:
            return logs.select("log_id", F.array().cast("array<string>").alias("parts")).limit(0)
        texts = logs.filter(F.col("description").isNotNull()).select("log_id", _padded(name_tokens("description")).alias("_text"))
        found = texts.mapInArrow(partial(_spoken, names, "log_id"), f"log_id {kind}, parts array<string>")
        hits = found.select("log_id", F.explode("parts").alias("part_name"))
    else:
        named = catalogue.select("part_name", F.col("_tokens")[0].alias("_first"), F.array_join("_tokens", " ").alias("_phrase"),
                                 F.size("_tokens").alias("_long"))
        words = logs.select("log_id", name_tokens("description").alias("_words"))
        places = words.select("log_id", "_words", F.posexplode("_words").alias("_at", "_first")).select(
            "log_id", "_first", F.slice("_words", F.col("_at") + 1, F.lit(size[1])).alias("_after"))
        here = F.array_join(F.slice("_after", F.lit(1), F.col("_long")), " ") == F.col("_phrase")
        hits = places.join(named, "_first").filter(here).select("log_id", "part_name")
    return hits.groupBy("log_id").agg(F.sort_array(F.collect_set("part_name")).alias("parts"))


def inventory_risk(parts: DataFrame, used: DataFrame, logs: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Risk of running out, from stock on hand and recent use per part."""
    days = rules.USAGE_WINDOW_DAYS
    start = as_of - dt.timedelta(days=days)
    recent = logs.filter((F.col("started_at") >= C.moment(start)) & (F.col("started_at") < C.moment(as_of)))
    usage = used.join(recent.select("log_id"), "log_id", "left_semi").groupBy("part_id").agg(
        F.sum("quantity_used").alias("_used"))
    joined = parts.join(usage, "part_id", "left").withColumn("used_90d", F.coalesce("_used", F.lit(0)))
    cover = F.when(F.col("_used") > 0, F.col("quantity_on_hand") * float(days) / F.col("_used"))
    timed = joined.withColumn("days_of_stock", cover)
    critical, _, medium = (name for _, name in rules.RISK_TIERS.bounds)
    idle = F.when(F.col("stock_status") == "REORDER_NEEDED", medium).otherwise(rules.RISK_TIERS.default)
    risk = (
        F.when(F.col("quantity_on_hand") <= 0, critical)
        .when(F.col("days_of_stock").isNull(), idle)
        .otherwise(C.tier("days_of_stock", rules.RISK_TIERS))
    )
    return timed.select("part_id", "quantity_on_hand", "used_90d", "days_of_stock", risk.alias("risk_level"))


def maintenance_digest(logs: DataFrame, count: int = 3) -> DataFrame:
    """The latest `count` sentences of each aircraft's logs: newest log first, in the order of its text.

    The rank filter is applied before the shuffle as well (Spark's window group
    limit), so an aircraft sends at most `count` rows per task and the
    collected list is bounded.
    """
    newest = Window.partitionBy("aircraft_id").orderBy(F.desc("started_at"), "log_id", "_at")
    cut = logs.select("aircraft_id", "started_at", "log_id", F.posexplode(sentences("description")).alias("_at", "_sentence"))
    kept = cut.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= count)
    collected = kept.groupBy("aircraft_id").agg(F.sort_array(F.collect_list(F.struct("_n", "_sentence"))).alias("_s"))
    texts = F.transform("_s", lambda item: item["_sentence"])
    return collected.select("aircraft_id", F.array_join(texts, " | ").alias("digest"))
