"""Text rules, zones, weather, parts and digests against brute force."""

import datetime as dt
import math
import re

from pyspark.sql import functions as F

from parcelwing import rules
from parcelwing.functions import text as T
from parcelwing.operators import enrichment, joins
from parcelwing.sources import adapter


def brute_score(text, lexicon):
    found = [w for token in re.split("[^a-z]+", text.lower()) for w, group in lexicon.items() if token in group]
    if not found:
        return 0.0
    return math.floor(abs(sum(found) / (10 * len(found))) * 1e4 + 0.5) / 1e4 * (1 if sum(found) >= 0 else -1)


def test_sentiment_of_whole_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for lexicon in (rules.SENTIMENT_LEXICON, adapter.TEST_LEXICON):
        rows = T.with_sentiment(docs, "text", lexicon).collect()
        assert all(r.sentiment_score == brute_score(r.text, lexicon) for r in rows)


def test_sentiment_edges(spark):
    df = spark.createDataFrame([("Great, GREAT!",), ("best worst",), ("bestest éworsté",), ("",), (None,)], "t string")
    scored = T.with_sentiment(df, "t").withColumn("l", T.sentiment_label("sentiment_score"))
    got = [(r.sentiment_score, r.l) for r in scored.collect()]
    assert got == [(1.0, "POSITIVE"), (0.0, "NEUTRAL"), (-1.0, "NEGATIVE"), (0.0, "NEUTRAL"), (None, "NEUTRAL")]
    bounds = spark.createDataFrame([(0.3,), (0.2999,), (-0.3,), (-0.2999,)], "s double").select(T.sentiment_label("s"))
    assert [r[0] for r in bounds.collect()] == ["POSITIVE", "NEUTRAL", "NEGATIVE", "NEUTRAL"]


def test_root_cause_and_category(spark):
    df = spark.createDataFrame([("Fixed. Root cause: loose cable. Done.",), ("motor and firmware",), ("lunch",), (None,)], "t string")
    got = [tuple(r) for r in T.with_text_category(df, "t").select(T.root_causes("t"), "text_category").collect()]
    assert got == [(["loose cable"], "ELECTRICAL"), ([], "MECHANICAL"), ([], "OTHER"), (None, "OTHER")]
    more = spark.createDataFrame([("Root cause: worn v3.2 chip. Root cause: dust.",), ("Root cause: dust",)], "t string")
    assert [r[0] for r in more.select(T.root_causes("t")).collect()] == [["worn v3.2 chip", "dust"], ["dust"]]


def test_parts_named_in_texts(spark):
    logs = spark.createDataFrame([("1", "New Red  Widget, and a rod."), ("2", "widget red"), ("3", None), ("4", "")], "log_id string, description string")
    parts = spark.createDataFrame([(" Red Widget ",), ("rod",), ("Red Widget",)], "part_name string")
    assert [(r.log_id, r.parts) for r in enrichment.parts_mentioned(logs, parts).collect()] == [("1", ["red widget", "rod"])]
    logs = spark.createDataFrame([("1", "Carbon fiber propeller, Motor 2212 and USB-C charge port swapped")], "log_id string, description string")
    parts = spark.createDataFrame([("carbon fiber propeller",), ("Motor 2212",), ("USB-C Charge Port",), ("motor",)], "part_name string")
    found = enrichment.parts_mentioned(logs, parts).collect()
    assert found[0].parts == ["carbon fiber propeller", "motor", "motor 2212", "usb-c charge port"]
    assert enrichment.parts_mentioned(logs, parts.limit(0)).count() == 0


def test_parts_of_any_script_by_automaton_and_by_first_token(spark):
    names = ["Étrier", "étrier", "Motor 2212", "motor", "모터", "ножной насос", "насос", "a b", "b a", "ß-plate", "--", None]
    texts = ["Un étrier, neuf", "ÉTRIER motor 2212 motor", "모터 교체", "ножной насос и насос", "a b a", "motors", "x" * 9000 + " a b", "", None,
             "ß plate ok", "the café étriers"]
    logs = spark.createDataFrame([(f"l{k}", t) for k, t in enumerate(texts)] + [("l1", "насос")], "log_id string, description string")
    parts = spark.createDataFrame([(n,) for n in names], "part_name string")
    want = {"l0": ["étrier"], "l1": ["motor", "motor 2212", "étrier", "насос"], "l2": ["모터"], "l3": ["насос", "ножной насос"],
            "l4": ["a b", "b a"], "l6": ["a b"], "l9": ["ß-plate"]}
    for most in (1 << 20, 0):
        found = enrichment.parts_mentioned(logs, parts, most)
        assert {r.log_id: sorted(r.parts) for r in found.collect()} == {k: sorted(v) for k, v in want.items()}
    plan = enrichment.parts_mentioned(logs, parts)._jdf.queryExecution().executedPlan().toString()
    assert "posexplode" not in plan


def km(a, b, c, d):
    p = math.pi / 180
    h = math.sin((c - a) * p / 2) ** 2 + math.cos(a * p) * math.cos(c * p) * math.sin((d - b) * p / 2) ** 2
    return 2 * rules.EARTH_RADIUS_KM * math.asin(math.sqrt(h))


def test_nearest_zone_matches_all_pairs(context):
    orders = context.silver["silver_orders"].select("order_id", "dropoff_lat", "dropoff_lon")
    zones = context.silver["silver_delivery_zones"]
    every = {r.order_id: r.zone_id for r in enrichment.zone_assignment(orders, zones).collect()}
    assert len(every) == orders.count()
    got = {order: zone for order, zone in every.items() if zone is not None}
    circles = [(z.zone_id, z.center_lat, z.center_lon, z.radius_km) for z in zones.collect()]
    wanted = {}
    for o in orders.collect():
        inside = [(round(d, 6), z) for z, lat, lon, r in circles if (d := km(o.dropoff_lat, o.dropoff_lon, lat, lon)) <= r]
        if inside:
            wanted[o.order_id] = min(inside)[1]
    assert got == wanted and len(wanted) > 100


def test_zones_at_high_latitudes(spark):
    orders = spark.createDataFrame([("a", 85.0, 0.3), ("b", -85.0, 0.3)], "order_id string, dropoff_lat double, dropoff_lon double")
    zones = spark.createDataFrame([("z", 85.0, 0.0, 4.0), ("y", -85.0, 0.0, 4.0)], "zone_id string, center_lat double, center_lon double, radius_km double")
    got = {r.order_id: r.zone_id for r in enrichment.zone_assignment(orders, zones).collect()}
    assert got == {"a": "z", "b": "y"}


def test_zones_across_the_180th_meridian(spark):
    orders = spark.createDataFrame([("a", 0.0, -179.99), ("b", 0.0, 179.0)], "order_id string, dropoff_lat double, dropoff_lon double")
    zones = spark.createDataFrame([("z", 0.0, 179.99, 5.0)], "zone_id string, center_lat double, center_lon double, radius_km double")
    assert {r.order_id: r.zone_id for r in enrichment.zone_assignment(orders, zones).collect()} == {"a": "z", "b": None}


def test_many_zones_on_one_spot(spark):
    """A pile of zones leaves few candidates; huge and polar zones touch few cells."""
    rows = [(f"z{k:05d}", 10.0, 20.0, 0.5 + (k * 7919 % 20011) / 5000) for k in range(20_000)]
    rows += [("globe", 5.0, 5.0, 25_000.0), ("pole", 89.5, 0.0, 120.0), ("dot", 0.0, 0.0, 0.0)]
    zones = spark.createDataFrame(rows, "zone_id string, center_lat double, center_lon double, radius_km double")
    assert enrichment.undominated_zones(zones).count() < 40
    assert enrichment.zone_cells(zones).groupBy("zone_id").count().agg(F.max("count")).first()[0] <= 36
    points = [("a", 10.0, 20.0), ("b", 10.01, 20.0), ("c", 10.0, 20.044), ("d", -60.0, -170.0), ("e", 89.9, 179.0), ("f", None, 0.0), ("g", 0.0, 0.0)]
    orders = spark.createDataFrame(points, "order_id string, dropoff_lat double, dropoff_lon double")
    got = {r.order_id: r.zone_id for r in enrichment.zone_assignment(orders, zones).collect()}
    want = {"f": None}
    for o, lat, lon in points:
        if lat is not None:
            want[o] = min((round(d, 6), z) for z, a, b, r in rows if (d := km(lat, lon, a, b)) <= r)[1]
    assert got == want and want["g"] == "dot"
    assert {r.zone_id for r in enrichment.zone_assignment(orders, zones.limit(0)).collect()} == {None}


def test_digest_takes_the_newest_sentences(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", f"l{i}", t + dt.timedelta(days=i), f"Step {i}.1 done") for i in range(5)] + [("a", "l9", t + dt.timedelta(days=4), "Tie. x."), ("b", "m", t, None)]
    df = spark.createDataFrame(rows, "aircraft_id string, log_id string, started_at timestamp_ntz, description string")
    digest = enrichment.maintenance_digest(df)
    assert [tuple(r) for r in digest.collect()] == [("a", "Step 4.1 done | Tie | x")]
    assert "WindowGroupLimit" in digest._jdf.queryExecution().executedPlan().toString()


def test_weather_joins_one_row_per_hour(spark):
    t = dt.datetime(2024, 1, 1, 10)
    weather = spark.createDataFrame([("w", t, "MILD", 9.0, 20.0, True), ("w", t + dt.timedelta(minutes=30), "SEVERE", 0.5, 60.0, False)],
                                    "station_id string, recorded_at timestamp_ntz, weather_severity string, visibility_km double, wind_speed_kmh double, is_flyable boolean")
    flights = spark.createDataFrame([("a", "w", t + dt.timedelta(minutes=m)) for m in (0, 5, 59, 60)], "aircraft_id string, station_id string, recorded_at timestamp_ntz")
    assert [tuple(r) for r in enrichment.weather_at_flight(flights, weather).collect()] == [("a", "w", t, 3, "SEVERE", 0.5, 60.0, False)]


def test_orphans_count_rows_and_nulls(spark):
    child = spark.createDataFrame([("x",)] * 5 + [("y",), (None,)], "fk string")
    parent = spark.createDataFrame([("y",)], "pk string")
    assert sorted(map(tuple, joins.orphans(child, "fk", parent, "pk").collect()), key=str) == [("x", 5), (None, 1)]


def test_inventory_risk_levels(spark):
    day = dt.datetime(2024, 1, 1)
    parts = spark.createDataFrame([("none", 0, "REORDER_NEEDED"), ("fast", 10, "IN_STOCK"), ("slow", 100, "IN_STOCK"), ("idle", 5, "REORDER_NEEDED"), ("calm", 50, "IN_STOCK")],
                                  "part_id string, quantity_on_hand int, stock_status string")
    logs = spark.createDataFrame([("l", day), ("old", day - dt.timedelta(days=91))], "log_id string, started_at timestamp_ntz")
    used = spark.createDataFrame([("fast", "l", 30), ("slow", "l", 90), ("calm", "old", 500)], "part_id string, log_id string, quantity_used int")
    got = {r.part_id: r.risk_level for r in enrichment.inventory_risk(parts, used, logs, day + dt.timedelta(days=1)).collect()}
    assert got == {"none": "CRITICAL", "fast": "HIGH", "slow": "LOW", "idle": "MEDIUM", "calm": "LOW"}
