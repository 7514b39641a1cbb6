"""Domain tables derived from the generic test tables by key arithmetic.

`RawTables(spark, folder)["orders"]` builds a domain table lazily, so a query
pays only for the tables it touches. Each rule uses integer arithmetic on the
keys, which any SQL engine reproduces exactly.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwing import rules
from parcelwing.functions import columns as C
from parcelwing.operators import shaping
from parcelwing.sources.schemas import TABLES

AS_OF = dt.datetime(2024, 1, 31)
LOAD_TS = dt.datetime(2024, 1, 31, 6)

# fixed values: columns of the generic test tables the derivations read
SOURCE_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}

# fixed values: literal material of the test data
AIRCRAFT_MODELS = (" Kestrel ", "Heron", "Osprey ", " Swallow", "Condor")
PART_CATEGORIES = (" airframe", "Avionics", "BATTERY", "motor ", "Payload", "rotor", " Sensor ", "wiring")
MAINTENANCE_TYPES = (
    "engine_overhaul", " Structural_Repair", "EMERGENCY ", "inspection", "Calibration", "scheduled", "PREVENTIVE",
)
MAINTENANCE_TEXTS = (
    " Swapped the small ring and a red widget after the battery ran hot. Root cause: worn battery connector. ",
    "Hundred hour check done. Firmware brought up to date and the new rod greased.",
    "Frame plate showed a crack. Fitted one cold plate. Root cause: hard landing on gravel.",
    " Motor bearing noisy, old gear exchanged. Sensor calibration repeated. Root cause: dust in the bearing.",
    "Nothing to repair",
)
FEEDBACK_CHANNELS = (" app", "Email", "SMS ", "web", "Phone")
WEATHER_CONDITIONS = (" clear", "Cloudy ", "FOG", "rain")
ORDER_STATUSES = {"F": " delivered", "O": "Pending "}
ORDER_PRIORITIES = {"1-URGENT": "critical ", "2-HIGH": "EXPRESS"}
EVENT_TYPES = {"signup": "TAKEOFF", "purchase": " delivered ", "view": "WAYPOINT", "click": "PREFLIGHT_CHECK"}
# order values outside this range have no mission or no route
MISSION_MIN_VALUE = 10000.0
ROUTE_MAX_VALUE = 480000.0
# the test texts are invented prose, so two frequent words stand in for mild polarity
TEST_LEXICON = {**rules.SENTIMENT_LEXICON, 1: ("the",), -1: ("and",)}


def _id(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def _pick(values, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _as_text_pair(lat: Column, lon: Column) -> Column:
    return F.concat(F.lit('{"lat":'), lat.cast("string"), F.lit(',"lon":'), lon.cast("string"), F.lit("}"))


class RawTables(Mapping):
    """Lazy mapping from raw table name to DataFrame."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._built: dict[str, DataFrame] = {}
        self._sources: dict[str, DataFrame] = {}
        self._base: DataFrame | None = None

    def __iter__(self) -> Iterator[str]:
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(name)
        if name not in self._built:
            table = TABLES[name]
            built = getattr(self, f"_{name}")()
            have = dict(built.dtypes)
            wanted = table.types
            same = [have[n] == t for n, t in wanted.items()]
            typed = [n if ok else F.col(n).cast(t).alias(n) for ok, (n, t) in zip(same, wanted.items())]
            self._built[name] = built.select(*typed)
        return self._built[name]

    def _open(self, name: str) -> DataFrame:
        return self.spark.read.schema(SOURCE_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def source(self, name: str) -> DataFrame:
        if name not in self._sources:
            self._sources[name] = self._open(name)
        return self._sources[name]

    def _size(self, name: str) -> Column:
        """Row count of a source table as a scalar subquery."""
        return self.source(name).agg(F.count(F.lit(1)).alias("n")).scalar()

    # --- shared pieces ------------------------------------------------------
    @staticmethod
    def _depot_lat(depot: Column) -> Column:
        return F.lit(20.0) + (depot % 40) * F.lit(0.5)

    @staticmethod
    def _depot_lon(depot: Column) -> Column:
        return F.lit(-120.0) + (depot % 97) * F.lit(0.5)

    @staticmethod
    def _created(k: Column, date: Column) -> Column:
        return C.plus(date, minute=k * 7919 % 1440, second=k % 60)

    @staticmethod
    def _delivered(k: Column, created: Column, status: Column) -> Column:
        at = C.plus(created, minute=15 + k * 31 % 106, second=k * 17 % 60)
        return F.when(status == "F", at)

    def _order_base(self) -> DataFrame:
        if self._base is None:
            self._base = self._derive_orders()
        return self._base

    def _derive_orders(self) -> DataFrame:
        k = F.col("o_orderkey")
        depot = k % self._size("supplier")
        lat, lon = self._depot_lat(depot), self._depot_lon(depot)
        created = self._created(k, F.col("o_orderdate"))
        return self.source("orders").select(
            k.alias("k"),
            "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
            (lat + ((k * 37 % 101) - 50) / F.lit(1000.0)).alias("pickup_lat"),
            (lon + ((k * 41 % 101) - 50) / F.lit(1000.0)).alias("pickup_lon"),
            (lat + ((k * 43 % 161) - 80) / F.lit(1000.0)).alias("dropoff_lat"),
            (lon + ((k * 47 % 161) - 80) / F.lit(1000.0)).alias("dropoff_lon"),
            created.alias("created_at"),
            self._delivered(k, created, F.col("o_orderstatus")).alias("delivered_at"),
        )

    # --- the sixteen tables -------------------------------------------------
    def _depots(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.source("supplier").select(
            _id("DEP-", k).alias("depot_id"),
            F.concat(F.lit("  "), "s_name", F.lit(" ")).alias("depot_name"),
            self._depot_lat(k).alias("lat"),
            self._depot_lon(k).alias("lon"),
            (5 + k % 20).alias("capacity"),
        )

    def _delivery_zones(self) -> DataFrame:
        k = F.col("p_partkey")
        depot = k % self._size("supplier")
        return self.source("part").select(
            _id("ZN-", k).alias("zone_id"),
            F.concat(F.lit(" "), "p_name", F.lit(" zone ")).alias("zone_name"),
            (self._depot_lat(depot) + (k % 5 - 2) * F.lit(0.03)).alias("center_lat"),
            (self._depot_lon(depot) + (k % 7 - 3) * F.lit(0.03)).alias("center_lon"),
            (3 + k % 6).alias("radius_km"),
            _pick((" urban ", "Suburban", "RURAL"), k % 3).alias("zone_type"),
            F.when(k % 7 != 0, k % 5 != 0).alias("is_active"),
        )

    def _no_fly_zones(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.source("supplier").select(
            _id("NFZ-", k).alias("nfz_id"),
            F.concat(F.lit(" no-fly "), "s_name").alias("zone_name"),
            (self._depot_lat(k) + F.lit(0.05)).alias("center_lat"),
            self._depot_lon(k).alias("center_lon"),
            ((k * 37 % 5000) / F.lit(1000.0) + F.lit(0.5)).alias("radius_km"),
            _pick((" permanent", "Temporary "), k % 2).alias("restriction_type"),
            C.plus(C.moment("2020-01-01 00:00:00"), day=k % 900).alias("effective_from"),
            F.when(k % 2 == 1, C.plus(C.moment("2023-01-01 00:00:00"), day=k * 7 % 800)).alias("effective_to"),
        )

    def _aircraft(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.source("customer").select(
            _id("AC-", k).alias("aircraft_id"),
            _pick(AIRCRAFT_MODELS, k % 5).alias("model"),
            F.concat(F.lit("SN"), F.lpad(k.cast("string"), 12, "0")).alias("serial_number"),
            F.when(k % 10 < 7, " active ").when(k % 10 < 9, "IN_MAINTENANCE").otherwise("Grounded").alias("status"),
            _id("DEP-", k % self._size("supplier")).alias("depot_id"),
            (F.abs("c_acctbal") / F.lit(5.0)).alias("total_flight_hours"),
            F.when(k % 25 != 0, F.date_sub(F.lit(AS_OF.date()), (k % 120).cast("int"))).alias("last_maintenance_date"),
        )

    def _customers(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.source("customer").select(*_customer_columns(k))

    def _orders(self) -> DataFrame:
        k, status = F.col("k"), F.col("o_orderstatus")
        priority = F.col("o_orderpriority")
        return self._order_base().select(
            _id("ORD-", k).alias("order_id"),
            _id("CUS-", F.col("o_custkey")).alias("customer_id"),
            "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon",
            ((k * 13 % 150 + 1) / F.lit(10.0)).alias("package_weight_kg"),
            F.when(priority.isin(*ORDER_PRIORITIES), _lookup(priority, ORDER_PRIORITIES))
            .when(priority != "4-NOT SPECIFIED", "Standard").alias("priority"),
            F.coalesce(
                _lookup(status, ORDER_STATUSES), F.when(k % 2 == 0, "CANCELLED").otherwise("failed")
            ).alias("status"),
            "created_at", "delivered_at",
        )

    def _mission_base(self) -> DataFrame:
        return self._order_base().filter(F.col("o_totalprice") >= MISSION_MIN_VALUE)

    def _missions(self) -> DataFrame:
        k, status = F.col("k"), F.col("o_orderstatus")
        order_status = F.when(status == "F", "DELIVERED").when(status == "O", "PENDING").when(
            k % 2 == 0, "CANCELLED").otherwise("FAILED")
        return self._mission_base().select(
            _id("MSN-", k).alias("mission_id"),
            _id("ORD-", k).alias("order_id"),
            _id("AC-", k % self._size("customer")).alias("aircraft_id"),
            F.concat(F.lit(" "), F.lower(shaping.mission_status(order_status, k % 2))).alias("status"),
            C.plus("created_at", minute=-(5 + k % 26)).alias("planned_departure"),
            F.when(k % 37 != 0, C.plus("created_at", minute=k % 16)).alias("actual_departure"),
            C.plus("created_at", minute=20 + k % 41).alias("planned_arrival"),
            F.col("delivered_at").alias("actual_arrival"),
            F.when(k % 15 != 0, F.concat(F.lit("  leg "), (k % 15).cast("string"), F.lit(" "))).alias("notes"),
        )

    def _route_base(self) -> DataFrame:
        return self._mission_base().filter(F.col("o_totalprice") <= ROUTE_MAX_VALUE)

    def _routes(self) -> DataFrame:
        k = F.col("k")
        points = [
            _as_text_pair(C.along("pickup_lat", "dropoff_lat", f), C.along("pickup_lon", "dropoff_lon", f))
            for f in rules.WAYPOINT_FRACTIONS
        ]
        text = F.concat(F.lit("["), F.concat_ws(",", *points), F.lit("]"))
        return self._route_base().select(
            _id("RT-", k).alias("route_id"),
            _id("MSN-", k).alias("mission_id"),
            F.col("pickup_lat").alias("origin_lat"), F.col("pickup_lon").alias("origin_lon"),
            F.col("dropoff_lat").alias("dest_lat"), F.col("dropoff_lon").alias("dest_lon"),
            ((k * 13 % 700) / F.lit(10.0)).alias("distance_km"),
            F.when(k % 97 == 0, 0).otherwise(8 + k * 7 % 47).alias("duration_min"),
            F.parse_json(text).alias("waypoints"),
        )

    def _route_segments(self) -> DataFrame:
        k = F.col("k")
        routes = self._route_base().select(
            k, _id("RT-", k).alias("route_id"),
            F.col("pickup_lat").alias("origin_lat"), F.col("pickup_lon").alias("origin_lon"),
            F.col("dropoff_lat").alias("dest_lat"), F.col("dropoff_lon").alias("dest_lon"),
            ((k * 13 % 700) / F.lit(10.0)).alias("distance_km"),
        )
        legs = shaping.split_route_segments(routes)
        return legs.select(
            F.concat("route_id", F.lit("-"), F.col("segment_seq").cast("string")).alias("segment_id"),
            "route_id", "segment_seq", "start_lat", "start_lon", "end_lat", "end_lon", "distance_km",
            (30 + (k * 17 + F.col("segment_seq") * 11) % 900 / F.lit(10.0)).alias("altitude_m"),
        )

    def _mission_events(self) -> DataFrame:
        k, kind = F.col("event_id"), F.col("event_type")
        return self.source("events").select(
            _id("EV-", k).alias("event_id"),
            _id("MSN-", F.col("user_id")).alias("mission_id"),
            F.coalesce(
                _lookup(kind, EVENT_TYPES), F.when(k % 2 == 0, "SYSTEM_FAILURE").otherwise(" low_battery")
            ).alias("event_type"),
            F.col("ts").alias("event_timestamp"),
            F.concat(F.lit(" "), kind, F.lit(" reported ")).alias("description"),
            (F.lit(20.0) + (k % 1000) / F.lit(100.0)).alias("lat"),
            (F.lit(-120.0) + (k % 3000) / F.lit(100.0)).alias("lon"),
        )

    def _flight_logs(self) -> DataFrame:
        k = F.col("event_id")
        return self.source("events").select(
            _id("FL-", k).alias("flight_log_id"),
            _id("AC-", F.col("user_id")).alias("aircraft_id"),
            F.col("ts").alias("recorded_at"),
            (F.lit(20.0) + (k % 4000) / F.lit(100.0)).alias("lat"),
            (F.lit(-120.0) + (k % 5000) / F.lit(100.0)).alias("lon"),
            ((k * 71 % 4200) / F.lit(10.0)).alias("altitude_m"),
            ((k * 53 % 1300) / F.lit(10.0)).alias("speed_kmh"),
            ((k * 37 % 1010) / F.lit(10.0)).alias("battery_pct"),
            ((k * 97 % 3600) / F.lit(10.0)).alias("heading_deg"),
        )

    def _weather_data(self) -> DataFrame:
        k = F.col("event_id")
        return self.source("events").select(
            _id("WX-", k).alias("weather_id"),
            _id("WS-", F.col("user_id") % 5).alias("station_id"),
            F.col("ts").alias("recorded_at"),
            ((k * 19 % 450) / F.lit(10.0) - F.lit(5.0)).alias("temp_c"),
            ((k * 29 % 600) / F.lit(10.0)).alias("wind_speed_kmh"),
            ((k * 23 % 3600) / F.lit(10.0)).alias("wind_direction_deg"),
            ((k * 31 % 200) / F.lit(10.0)).alias("visibility_km"),
            ((k * 43 % 250) / F.lit(10.0)).alias("precipitation_mm"),
            _pick(WEATHER_CONDITIONS, k % 4).alias("conditions"),
        )

    def _parts_inventory(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.source("part").select(
            _id("PRT-", k).alias("part_id"),
            F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("part_name"),
            _pick(PART_CATEGORIES, k % 8).alias("category"),
            F.col("p_size").alias("quantity_on_hand"),
            (k % 40).alias("reorder_level"),
            F.col("p_retailprice").alias("unit_cost"),
            _id("DEP-", k % self._size("supplier")).alias("depot_id"),
        )

    def _maintenance_logs(self) -> DataFrame:
        k = F.col("o_orderkey")
        started = self._created(k, F.col("o_orderdate"))
        return self.source("orders").select(
            _id("ML-", k).alias("log_id"),
            _id("AC-", k * 3 % self._size("customer")).alias("aircraft_id"),
            _pick(MAINTENANCE_TYPES, k % 7).alias("maintenance_type"),
            _pick(MAINTENANCE_TEXTS, k % 5).alias("description"),
            _id(" Tech ", k % 10).alias("technician"),
            started.alias("started_at"),
            F.when(k % 9 != 0, C.plus(started, minute=60 + k % 2000)).alias("completed_at"),
            F.when(k % 9 != 0, " completed").otherwise("in_progress").alias("status"),
        )

    def _parts_used(self) -> DataFrame:
        order, line = F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")
        lines = self.source("lineitem").groupBy("l_orderkey", "l_linenumber").agg(
            F.min("l_partkey").alias("part"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("quantity_used"),
            C.fixed_sum("l_extendedprice", 2).alias("cost"),
        )
        return lines.select(
            F.concat(F.lit("PU-"), order, F.lit("-"), line).alias("usage_id"),
            F.concat(F.lit("ML-"), order).alias("log_id"),
            _id("PRT-", F.col("part")).alias("part_id"),
            "quantity_used", "cost",
        )

    def _delivery_feedback(self) -> DataFrame:
        k = F.col("doc_id")
        docs = self.source("documents").select("doc_id", "text")
        base = self._order_base().select("k", "o_custkey", "created_at", "delivered_at")
        return docs.join(base, F.col("k") == k).select(
            _id("FB-", k).alias("feedback_id"),
            _id("ORD-", k).alias("order_id"),
            _id("CUS-", F.col("o_custkey")).alias("customer_id"),
            (1 + k % 5).alias("rating"),
            F.when(k % 40 != 0, F.col("text")).alias("comments"),
            _pick(FEEDBACK_CHANNELS, k % 5).alias("feedback_channel"),
            C.plus(F.coalesce("delivered_at", "created_at"), minute=30 + k % 1411).alias("created_at"),
        )


def _lookup(value: Column, table: dict[str, str]) -> Column:
    chain = F
    for key, label in table.items():
        chain = chain.when(value == key, F.lit(label))
    return chain


def _customer_columns(k: Column) -> list[Column]:
    return [
        _id("CUS-", k).alias("customer_id"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("name"),
        F.concat(F.lit(" USER"), k.cast("string"), F.lit("@EXAMPLE.COM ")).alias("email"),
        F.concat(
            F.lit("+1-("), (200 + k % 800).cast("string"), F.lit(") "),
            F.lpad((k % 10000).cast("string"), 4, "0"),
        ).alias("phone"),
        F.concat(F.lit(" "), k.cast("string"), F.lit(" "), F.col("c_mktsegment"), F.lit(" Street ")).alias("address"),
        C.plus(C.moment("2020-01-01 00:00:00"), day=k % 1000).alias("created_at"),
    ]


def customer_versions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three versions of the customer table.

    First change: every 17th row deleted, every 11th phone changed, a new row
    for every 13th. Second change: half of the deleted rows come back, half of
    the new ones go, some phones change again and some change back.
    """
    k = F.col("c_custkey")
    base = RawTables(spark, folder).source("customer")
    phone = F.col("phone")

    def version(present: Column, suffix: Column, added: Column) -> DataFrame:
        kept = base.filter(present).select(*_customer_columns(k), suffix.alias("_suffix"))
        kept = kept.withColumn("phone", F.concat(phone, "_suffix")).drop("_suffix")
        new = base.filter(added).withColumn("c_custkey", k + 1000000).select(*_customer_columns(k))
        return kept.unionByName(new)

    moved = F.when(k % 11 == 0, "-9").otherwise("")
    moved_again = F.when(k % 33 == 0, "-8").when((k % 11 == 0) & (k % 22 != 0), "-9").otherwise("")
    return (
        base.select(*_customer_columns(k)),
        version(k % 17 != 0, moved, k % 13 == 0),
        version((k % 17 != 0) | (k % 34 == 0), moved_again, (k % 13 == 0) & (k % 26 != 0)),
    )


class StreamingTables(RawTables):
    """The same derivations over streams of the test tables' files."""

    def _open(self, name: str) -> DataFrame:
        # the pattern form accepts a single file as well as a folder of files
        return self.spark.readStream.schema(SOURCE_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet*")
