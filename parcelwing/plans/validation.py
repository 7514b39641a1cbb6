"""The validation suite: check specifications over the layers, and their report."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from parcelwing import rules
from parcelwing.functions import columns as C
from parcelwing.operators import quality as Q
from parcelwing.plans.layers import Layers
from parcelwing.session import scratch
from parcelwing.sources.schemas import TABLES

# --- fixed values: what is checked ------------------------------------------
SILVER_KEYS = {f"silver_{name}": table.key for name, table in TABLES.items()}
SILVER_REQUIRED = (
    ("silver_aircraft", "aircraft_id"),
    ("silver_customers", "customer_id"),
    ("silver_orders", "order_id"),
    ("silver_orders", "customer_id"),
    ("silver_missions", "mission_id"),
    ("silver_missions", "aircraft_id"),
    ("silver_flight_logs", "aircraft_id"),
    ("silver_delivery_feedback", "order_id"),
    ("silver_maintenance_logs", "aircraft_id"),
    ("silver_routes", "mission_id"),
)
CHECKED_REFERENCES = (
    ("orders", "customer_id", "customers"),
    ("missions", "order_id", "orders"),
    ("missions", "aircraft_id", "aircraft"),
    ("mission_events", "mission_id", "missions"),
    ("routes", "mission_id", "missions"),
    ("delivery_feedback", "order_id", "orders"),
    ("aircraft", "depot_id", "depots"),
    ("parts_inventory", "depot_id", "depots"),
    ("parts_used", "log_id", "maintenance_logs"),
    ("route_segments", "route_id", "routes"),
)
# model, column, smallest allowed, largest allowed, whether the smallest itself is excluded
RANGES = (
    ("silver_delivery_feedback", "rating", 1, 5, False),
    ("silver_delivery_feedback", "sentiment_score", -1, 1, False),
    ("silver_flight_logs", "battery_pct", 0, 100, False),
    ("silver_flight_logs", "speed_kmh", 0, None, False),
    ("silver_flight_logs", "altitude_m", 0, None, False),
    ("silver_flight_logs", "lat", -90, 90, False),
    ("silver_flight_logs", "lon", -180, 180, False),
    ("silver_orders", "package_weight_kg", 0, None, True),
    ("silver_orders", "delivery_time_min", 0, None, False),
    ("silver_routes", "distance_km", 0, None, False),
    ("silver_parts_inventory", "unit_cost", 0, None, True),
)
VOCABULARIES = (
    ("silver_orders", "priority", rules.ACCEPTED_PRIORITIES),
    ("silver_weather_data", "weather_severity", rules.WEATHER_SEVERITIES),
)
GOLD_COUNTS = (
    ("fct_deliveries", "silver_orders"),
    ("fct_maintenance", "silver_maintenance_logs"),
    ("dim_aircraft", "silver_aircraft"),
    ("dim_customers", "silver_customers"),
    ("dim_depots", "silver_depots"),
    ("dim_delivery_zones", "silver_delivery_zones"),
)
GOLD_KEYS = (
    ("fct_deliveries", ("order_id",)),
    ("fct_maintenance", ("log_id",)),
    ("dim_aircraft", ("aircraft_id",)),
    ("dim_customers", ("customer_id",)),
    ("dim_depots", ("depot_id",)),
    ("dim_delivery_zones", ("zone_id",)),
    ("kpi_delivery_performance", ("report_date",)),
    ("fct_flight_telemetry", ("aircraft_id", "hour_bucket")),
)
GOLD_REQUIRED = (
    ("fct_deliveries", "order_id"),
    ("fct_deliveries", "customer_id"),
    ("fct_maintenance", "log_id"),
    ("dim_aircraft", "aircraft_id"),
    ("dim_customers", "customer_id"),
    ("kpi_delivery_performance", "report_date"),
)
FLOWS = (
    ("orders", "fct_deliveries"),
    ("aircraft", "dim_aircraft"),
    ("customers", "dim_customers"),
    ("maintenance_logs", "fct_maintenance"),
)
POPULATED_PCT = 95
PARALLEL_JOBS = 4
LAYER_SIZES = {"bronze": len(TABLES), "silver": 17, "gold": 8}


# --- naming -------------------------------------------------------------------
def range_name(model: str, column: str, low, high, open_low: bool) -> str:
    below = f"{'above' if open_low else 'from'} {low}"
    return f"{model}.{column} {below}" + ("" if high is None else f" to {high}")


def reference_name(child: str, column: str, parent: str) -> str:
    return f"{child}.{column} in {parent}"


# --- the checks -----------------------------------------------------------------
def _by_model(specs: list[Q.RuleSpec], tables, name_column: str, count_column: str) -> DataFrame:
    grouped: dict[str, list[Q.RuleSpec]] = defaultdict(list)
    for spec in specs:
        grouped[spec.model].append(spec)
    return Q.stacked([Q.check_rules(tables[m], group, name_column, count_column) for m, group in grouped.items()])


def check_row_count_match(layers: Layers) -> DataFrame:
    return Q.stacked([
        Q.check_same_count("entity", name, "source_count", "bronze_count", Q.FAIL,
                           source_count=layers.raw[name], bronze_count=layers.bronze[name])
        for name in TABLES
    ])


def check_pk_unique(layers: Layers) -> DataFrame:
    return Q.stacked([Q.check_key(layers.silver[m], Q.KeySpec(m, (k,))) for m, k in SILVER_KEYS.items()])


def _required(tables, required) -> DataFrame:
    specs = [Q.RuleSpec(f"{m}.{column}", m, F.col(column).isNull()) for m, column in required]
    return _by_model(specs, tables, "check_column", "null_count")


def check_not_null(layers: Layers) -> DataFrame:
    return _required(layers.silver, SILVER_REQUIRED)


def _references_among(silver: Mapping[str, DataFrame]) -> list[DataFrame]:
    return [
        Q.check_orphans(reference_name(child, column, parent), silver[f"silver_{child}"], column,
                        silver[f"silver_{parent}"], TABLES[parent].key)
        for child, column, parent in CHECKED_REFERENCES
    ]


def check_foreign_key(layers: Layers) -> DataFrame:
    return Q.stacked(_references_among(layers.silver))


def _range_specs() -> list[Q.RuleSpec]:
    specs = []
    for model, column, low, high, open_low in RANGES:
        value = F.col(column)
        outside = value <= low if open_low else value < low
        if high is not None:
            outside = outside | (value > high)
        specs.append(Q.RuleSpec(range_name(model, column, low, high, open_low), model, outside))
    return specs


def check_range(layers: Layers) -> DataFrame:
    return _by_model(_range_specs(), layers.silver, "check_name", "violation_count")


def _vocabulary_specs(vocabularies=VOCABULARIES) -> list[Q.RuleSpec]:
    return [Q.RuleSpec(f"{m}.{c} vocabulary", m, ~F.col(c).isin(*allowed)) for m, c, allowed in vocabularies]


def check_accepted_values(layers: Layers, vocabularies=VOCABULARIES) -> DataFrame:
    return _by_model(_vocabulary_specs(vocabularies), layers.silver, "check_name", "violation_count")


def check_gold_count(layers: Layers) -> DataFrame:
    return Q.stacked([
        Q.check_same_count("check_name", f"{gold} vs {silver}", "gold_count", "silver_count", Q.WARN,
                           gold_count=layers.gold[gold], silver_count=layers.silver[silver])
        for gold, silver in GOLD_COUNTS
    ])


def check_gold_pk_unique(layers: Layers) -> DataFrame:
    return Q.stacked([Q.check_key(layers.gold[m], Q.KeySpec(m, columns)) for m, columns in GOLD_KEYS])


def check_gold_not_null(layers: Layers) -> DataFrame:
    return _required(layers.gold, GOLD_REQUIRED)


def check_layer_counts(layers: Layers) -> DataFrame:
    return Q.stacked([
        Q.counts_side_by_side("check_name", f"{name} flow", source_count=layers.raw[name], bronze_count=layers.bronze[name],
                              silver_count=layers.silver[f"silver_{name}"], gold_count=layers.gold[gold])
        for name, gold in FLOWS
    ])


def check_populated_pct(layers: Layers) -> DataFrame:
    def enough(total, ok):
        return C.safe_divide(ok * 100.0, total) >= POPULATED_PCT

    return Q.check_share(layers.silver["silver_delivery_feedback"], "sentiment populated",
                         F.col("sentiment_score").isNotNull(), enough)


def check_label_valid(layers: Layers) -> DataFrame:
    """A null label is neither valid nor a violation, and an empty table fails."""
    label = F.col("sentiment_label")
    wrong = layers.silver["silver_delivery_feedback"].agg(
        F.count(F.lit(1)).alias("total_records"),
        C.count_if(label.isin(*rules.SENTIMENT_LABELS)).alias("good_records"),
        C.count_if(~label.isin(*rules.SENTIMENT_LABELS)).alias("_wrong"),
    )
    return wrong.select(
        F.lit("sentiment label valid").alias("check_name"), "total_records", "good_records",
        C.percent(F.col("good_records"), F.col("total_records")).alias("pct_good"), Q.verdict(F.col("_wrong") == 0),
    )


def check_layer_inventory(inventory: DataFrame) -> DataFrame:
    """Published relations per layer against the number of models."""
    expected = F
    for layer, size in LAYER_SIZES.items():
        expected = expected.when(F.col("layer") == layer, F.lit(size))
    sized = inventory.select("layer", expected.alias("expected_relations"), F.col("relations").alias("actual_relations"),
                             "total_rows")
    return sized.withColumn("status", Q.verdict(F.col("expected_relations") == F.col("actual_relations")))


def _same(otherwise: str = Q.FAIL):
    return lambda observed, expected: Q.verdict(observed == expected, otherwise)


def _info(observed, expected):
    return F.lit("INFO")


def _rules() -> list[tuple[str, Q.RuleSpec]]:
    """Every per-row rule of the suite with the group it is reported under."""
    found = [("silver not null", Q.RuleSpec(f"{m}.{c}", m, F.col(c).isNull())) for m, c in SILVER_REQUIRED]
    found += [("range", spec) for spec in _range_specs()]
    found += [("vocabulary", spec) for spec in _vocabulary_specs()]
    found += [("gold not null", Q.RuleSpec(f"{m}.{c}", m, F.col(c).isNull())) for m, c in GOLD_REQUIRED]
    return found


class _Pass:
    """One run over a model: its figures are observed while its keys are written."""

    def __init__(self, df: DataFrame, model: str, figures: dict[str, Column], columns: list[str], folder: str):
        self.model, self.names = model, list(figures)
        self.seen, self.path = Observation(), f"{folder}/{model}"
        observed = df.observe(self.seen, *[c.cast("bigint").alias(f"f{i}") for i, c in enumerate(figures.values())])
        self.keys = observed.select(*columns)

    def run(self) -> None:
        self.keys.write.parquet(self.path)

    def stored(self) -> DataFrame:
        return self.keys.sparkSession.read.schema(self.keys.schema).parquet(self.path)

    def figures(self) -> list[tuple[str, str, int]]:
        got = self.seen.get
        return [(self.model, name, got[f"f{i}"]) for i, name in enumerate(self.names)]


def _watched(layers: Layers) -> tuple[Layers, dict[str, Observation]]:
    """The same layers, with rows of raw and bronze counted as they pass to silver."""
    rows, seen = F.count(F.lit(1)).alias("rows"), {}
    raw = {}
    for name in TABLES:
        seen[f"raw_{name}"], seen[f"bronze_{name}"] = Observation(), Observation()
        raw[name] = layers.raw[name].observe(seen[f"raw_{name}"], rows)
    watched = Layers(raw, layers.as_of, layers.load_ts, layers.lexicon)
    for name in TABLES:
        watched.bronze.replace(name, watched.bronze[name].observe(seen[f"bronze_{name}"], rows))
    return watched, seen


def _run_all(passes: list[_Pass]) -> None:
    """Small jobs side by side: none of them fills the cluster alone."""
    with ThreadPoolExecutor(PARALLEL_JOBS) as pool:
        list(pool.map(_Pass.run, passes))


def validation_summary(layers: Layers) -> DataFrame:
    """Every check as (check_group, check_name, observed, expected, status).

    Each model is derived once. Counts and rule violations are observed while its
    keys are written; what needs a shuffle, distinct keys and orphans, reads the
    written keys alone. The checks are judged from these figures.
    """
    rows = F.count(F.lit(1))
    keys = {m: (k,) for m, k in SILVER_KEYS.items()} | dict(GOLD_KEYS)
    rule_list = _rules()
    label = F.col("sentiment_label")
    scored = {
        "scored": C.count_if(F.col("sentiment_score").isNotNull()),
        "labelled": C.count_if(label.isin(*rules.SENTIMENT_LABELS)),
        "mislabelled": C.count_if(~label.isin(*rules.SENTIMENT_LABELS)),
    }
    watched, seen = _watched(layers)
    any_table = layers.raw[next(iter(TABLES))]
    folder = scratch(any_table.sparkSession, "keys")
    passes: dict[str, _Pass] = {}
    for model, columns in keys.items():
        figures = {"rows": rows}
        for group, spec in rule_list:
            if spec.model == model:
                figures[f"{group}:{spec.name}"] = C.count_if(spec.violation)
        if model == "silver_delivery_feedback":
            figures |= scored
        parents = [c for child, c, _ in CHECKED_REFERENCES if f"silver_{child}" == model]
        source = watched.silver if model in layers.silver else layers.gold
        passes[model] = _Pass(source[model], model, figures, list(dict.fromkeys([*columns, *parents])), folder)
    _run_all(list(passes.values()))

    found = [(table, "rows", one.get["rows"]) for table, one in seen.items()]
    found += [figure for one in passes.values() for figure in one.figures()]
    held = {model: one.stored() for model, one in passes.items()}
    parts = [any_table.sparkSession.createDataFrame(found, "table string, figure string, value long")]
    parts += [Q.profile(held[m], m, {"keys": F.countDistinct(*columns)}) for m, columns in keys.items()]
    parts += [
        check.select(F.col("relationship").alias("table"), F.lit("orphans").alias("figure"), F.col("orphan_count").alias("value"))
        for check in _references_among(held)
    ]
    relations = {"bronze": len(layers.bronze), "silver": len(layers.silver), "gold": len(layers.gold)}

    findings = [Q.Finding("row count", n, (f"bronze_{n}", "rows"), (f"raw_{n}", "rows"), _same()) for n in TABLES]
    findings += [
        Q.Finding("silver key" if m in layers.silver else "gold key", m, (m, "keys"), (m, "rows"), _same()) for m in keys]
    findings += [Q.Finding(g, s.name, (s.model, f"{g}:{s.name}"), 0, _same()) for g, s in rule_list]
    findings += [Q.Finding("reference", reference_name(*r), (reference_name(*r), "orphans"), 0, _same())
                 for r in CHECKED_REFERENCES]
    findings += [Q.Finding("gold count", f"{g} vs {s}", (g, "rows"), (s, "rows"), _same(Q.WARN)) for g, s in GOLD_COUNTS]
    findings += [Q.Finding("flow", f"{n} flow", (g, "rows"), (f"raw_{n}", "rows"), _info) for n, g in FLOWS]
    feedback = "silver_delivery_feedback"
    findings += [
        Q.Finding("sentiment", "sentiment populated", (feedback, "scored"), (feedback, "rows"),
                  lambda o, e: Q.verdict(C.safe_divide(o * 100.0, e) >= POPULATED_PCT)),
        Q.Finding("sentiment", "sentiment label valid", (feedback, "mislabelled"), 0, _same()),
    ]
    findings += [Q.Finding("inventory", layer, n, LAYER_SIZES[layer], _same()) for layer, n in relations.items()]
    return Q.report(Q.stacked(parts), findings)
