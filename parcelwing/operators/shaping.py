"""Row-shaping operators: round-robin assignment, paths, legs, schedules, spines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwing import rules
from parcelwing.functions import columns as C
from parcelwing.operators.windows import number_globally


def mission_status(order_status: Column, coin: Column) -> Column:
    """Mission status that follows from an order status; open orders alternate."""
    waiting, flying = rules.PENDING_MISSION_STATUSES
    chain = F.when(order_status == "PENDING", F.when(coin == 0, waiting).otherwise(flying))
    for source, target in rules.MISSION_STATUS_BY_ORDER.items():
        chain = chain.when(order_status == source, target)
    return chain.otherwise(rules.MISSION_STATUS_DEFAULT)


def expand(df: DataFrame, rows, names: tuple[str, ...]) -> DataFrame:
    """Each row once per template row.

    The template is a fixed literal list, so it travels inside the projection
    as an array and needs neither a join nor a shuffle.
    """
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return df.withColumn("_t", F.explode(F.array(*structs))).select("*", "_t.*").drop("_t")


def split_route_segments(routes: DataFrame) -> DataFrame:
    """Four equal legs per route with their end points."""
    legs = expand(routes, rules.ROUTE_LEGS, ("segment_seq", "_from", "_to"))
    corners = {
        "start_lat": ("origin_lat", "dest_lat", "_from"), "start_lon": ("origin_lon", "dest_lon", "_from"),
        "end_lat": ("origin_lat", "dest_lat", "_to"), "end_lon": ("origin_lon", "dest_lon", "_to"),
    }
    for name, (a, b, at) in corners.items():
        legs = legs.withColumn(name, C.along(a, b, F.col(at)))
    return legs.withColumn("distance_km", F.col("distance_km") / F.lit(float(len(rules.ROUTE_LEGS)))).drop("_from", "_to")


def expand_event_schedule(missions: DataFrame) -> DataFrame:
    """Planned milestones per mission at fixed shares of its duration.

    Needs mission_id, actual_departure and actual_arrival; a mission without an
    arrival is taken to last a fixed number of minutes.
    """
    started = missions.filter(F.col("actual_departure").isNotNull())
    end = F.coalesce("actual_arrival", C.plus("actual_departure", minute=rules.OPEN_MISSION_MINUTES))
    timed = started.withColumn("_span", C.seconds_between("actual_departure", end))
    rows = expand(timed, rules.MILESTONES, ("event_seq", "event_type", "_share"))
    offset = C.round_half_up(F.col("_span") * F.col("_share"), 0).cast("bigint")
    return rows.withColumn("event_timestamp", C.plus("actual_departure", second=offset)).drop("_span", "_share")


def interpolate_path(df: DataFrame, points: int, lat: tuple[str, str], lon: tuple[str, str]) -> DataFrame:
    """`points` positions per row on the line from origin to destination."""
    numbered = df.withColumn("point_seq", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    share = F.col("point_seq") / F.lit(float(points))
    return numbered.withColumn("lat", C.along(*lat, share)).withColumn("lon", C.along(*lon, share))


def hour_grid(entities: DataFrame, start: str, end: str) -> DataFrame:
    """Each entity once per hour from its first to its last hour, both included."""
    first, last = C.trunc_to("hour", start), C.trunc_to("hour", end)
    return entities.withColumn("hour_ts", F.explode(F.sequence(first, last, F.expr("interval 1 hour"))))


def assign_round_robin(df: DataFrame, key: str, members: DataFrame, member_key: str, member_cols: list[str]) -> DataFrame:
    """Give every row a member by key modulo the number of members.

    Members are ranked here by `member_key`, a unique integer, so gaps in it
    leave no row without a member. The computed key is materialised so that the
    join is an ordinary equi join. A row without a key, or without any members to
    choose from, stays and gets none.
    """
    total = members.agg(F.count(F.lit(1)).alias("n")).scalar()
    slots = number_globally(members, member_key, 1_000_000, "_slot").select("_slot", *member_cols)
    return df.withColumn("_slot", F.pmod(F.col(key), total)).join(slots, "_slot", "left").drop("_slot")


def waypoint_rows(routes: DataFrame) -> DataFrame:
    """One row per waypoint of a variant array column `waypoints`."""
    points = F.variant_get("waypoints", "$", "array<struct<lat:double,lon:double>>")
    exploded = routes.select("*", F.posexplode(points).alias("waypoint_index", "_p"))
    return exploded.select("*", "_p.lat", "_p.lon").drop("_p", "waypoints")
