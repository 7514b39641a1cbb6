"""Queries: data-quality checks."""

from __future__ import annotations

from parcelwing import rules
from parcelwing.catalog.domain_sql import count_if, pct, words
from parcelwing.catalog.registry import query
from parcelwing.plans import gold, silver
from parcelwing.plans import validation as V
from parcelwing.sources import tables
from parcelwing.sources.schemas import TABLES


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


def _status(condition: str, otherwise: str = "FAIL") -> str:
    return f"CASE WHEN {condition} THEN 'PASS' ELSE '{otherwise}' END AS status"


def _keys(pairs) -> str:
    def one(model: str, columns: tuple[str, ...]) -> str:
        distinct = columns[0] if len(columns) == 1 else f"({', '.join(columns)})"
        return (f"SELECT '{model}' AS model, '{'+'.join(columns)}' AS pk_column, count(*) AS total_rows, "
                f"count(DISTINCT {distinct}) AS distinct_keys, {_status(f'count(*) = count(DISTINCT {distinct})')} FROM {model}")
    return _union(one(m, c) for m, c in pairs)


def _rule(name: str, violation: str, model: str, name_column: str, count_column: str) -> str:
    n = count_if(violation)
    return f"SELECT '{name}' AS {name_column}, {n} AS {count_column}, {_status(f'{n} = 0')} FROM {model}"


def _required(pairs) -> str:
    return _union(_rule(f"{m}.{c}", f"{c} IS NULL", m, "check_column", "null_count") for m, c in pairs)


def _outside(column: str, low, high, open_low: bool) -> str:
    return f"{column} {'<=' if open_low else '<'} {low}" + ("" if high is None else f" OR {column} > {high}")


def _count(name: str) -> str:
    return f"(SELECT count(*) FROM {name})"


def _kept(table: str) -> str:
    """Rows that bronze holds: all of the raw table, whether they have a key or not."""
    return f"(SELECT count(*) FILTER (WHERE {TABLES[table].key} IS NULL) + count({TABLES[table].key}) FROM raw_{table})"


SQL = {
    "check_row_count_match": _union(
        f"SELECT '{t}' AS entity, {_count(f'raw_{t}')} AS source_count, {_kept(t)} AS bronze_count, "
        f"{_status(f'{_count(f'raw_{t}')} = {_kept(t)}')}" for t in TABLES),
    "check_pk_unique": _keys((m, (k,)) for m, k in V.SILVER_KEYS.items()),
    "check_not_null": _required(V.SILVER_REQUIRED),
    "check_foreign_key": _union(
        f"SELECT '{V.reference_name(c, k, p)}' AS relationship, count(*) AS orphan_count, {_status('count(*) = 0')} "
        f"FROM silver_{c} WHERE {k} IS NULL OR {k} NOT IN (SELECT {TABLES[p].key} FROM silver_{p})"
        for c, k, p in V.CHECKED_REFERENCES),
    "check_range": _union(
        _rule(V.range_name(*r), _outside(*r[1:]), r[0], "check_name", "violation_count") for r in V.RANGES),
    "check_accepted_values": _union(
        _rule(f"{m}.{c} vocabulary", f"{c} NOT IN {words(ws)}", m, "check_name", "violation_count")
        for m, c, ws in V.VOCABULARIES),
    "check_gold_count": _union(
        f"SELECT '{g} vs {s}' AS check_name, {_count(g)} AS gold_count, {_count(s)} AS silver_count, "
        f"{_status(f'{_count(g)} = {_count(s)}', 'WARN - INVESTIGATE')}" for g, s in V.GOLD_COUNTS),
    "check_gold_pk_unique": _keys(V.GOLD_KEYS),
    "check_gold_not_null": _required(V.GOLD_REQUIRED),
    "check_layer_counts": _union(
        f"SELECT '{n} flow' AS check_name, {_count(f'raw_{n}')} AS source_count, {_count(f'raw_{n}')} AS bronze_count, "
        f"{_count(f'silver_{n}')} AS silver_count, {_count(g)} AS gold_count" for n, g in V.FLOWS),
}
_SCORED = count_if("sentiment_score IS NOT NULL")
_VALID = count_if(f"sentiment_label IN {words(rules.SENTIMENT_LABELS)}")
_INVALID = count_if(f"sentiment_label NOT IN {words(rules.SENTIMENT_LABELS)}")
SQL["check_populated_pct"] = (
    f"SELECT 'sentiment populated' AS check_name, count(*) AS total_records, {_SCORED} AS good_records, "
    f"{pct(_SCORED, 'count(*)')} AS pct_good, {_status(f'{_SCORED} * 1e2 / count(*) >= {V.POPULATED_PCT}')} FROM silver_delivery_feedback")
SQL["check_label_valid"] = (
    f"SELECT 'sentiment label valid' AS check_name, count(*) AS total_records, {_VALID} AS good_records, "
    f"{pct(_VALID, 'count(*)')} AS pct_good, {_status(f'{_INVALID} = 0')} FROM silver_delivery_feedback")

for _name, _sql in SQL.items():
    query(_name, _sql)(lambda c, f=getattr(V, _name): f(c.layers))


def _part(group: str, check: str, name: str, observed: str, expected: str, status: str = "status") -> str:
    return (f"SELECT '{group}' AS check_group, {name} AS check_name, {observed} AS observed, "
            f"{expected} AS expected, {status} AS status FROM ({SQL[check]})")


_ZERO = "CAST(0 AS BIGINT)"
SUMMARY = _union([
    _part("row count", "check_row_count_match", "entity", "bronze_count", "source_count"),
    _part("silver key", "check_pk_unique", "model", "distinct_keys", "total_rows"),
    _part("silver not null", "check_not_null", "check_column", "null_count", _ZERO),
    _part("reference", "check_foreign_key", "relationship", "orphan_count", _ZERO),
    _part("range", "check_range", "check_name", "violation_count", _ZERO),
    _part("vocabulary", "check_accepted_values", "check_name", "violation_count", _ZERO),
    _part("gold count", "check_gold_count", "check_name", "gold_count", "silver_count"),
    _part("gold key", "check_gold_pk_unique", "model", "distinct_keys", "total_rows"),
    _part("gold not null", "check_gold_not_null", "check_column", "null_count", _ZERO),
    _part("flow", "check_layer_counts", "check_name", "gold_count", "source_count", "'INFO'"),
    _part("sentiment", "check_populated_pct", "check_name", "good_records", "total_records"),
    f"SELECT 'sentiment' AS check_group, 'sentiment label valid' AS check_name, {_INVALID} AS observed, "
    f"{_ZERO} AS expected, {_status(f'{_INVALID} = 0')} FROM silver_delivery_feedback",
])


_LAYERS = {
    "bronze": [f"raw_{t}" for t in TABLES], "silver": list(silver.MODELS), "gold": list(gold.MODELS),
}
SUMMARY += " UNION ALL " + _union(
    f"SELECT 'inventory' AS check_group, '{layer}' AS check_name, count(*) AS observed, CAST({V.LAYER_SIZES[layer]} AS BIGINT) AS expected, "
    f"{_status(f'count(*) = {V.LAYER_SIZES[layer]}')} FROM ({_union(f'SELECT count(*) AS n FROM {name}' for name in names)})"
    for layer, names in _LAYERS.items())
query("validation_summary", SUMMARY)(lambda c: V.validation_summary(c.layers))


_INVENTORY = _union(
    f"SELECT '{layer}' AS layer, count(*) AS relations, CAST(sum(n) AS BIGINT) AS total_rows FROM "
    f"({_union(f'SELECT count(*) AS n FROM {name}' for name in names)})" for layer, names in _LAYERS.items())


def _inventory(c):
    """Publish every model as a view, then read the catalog back."""
    for name in TABLES:
        tables.publish_view(c.bronze[name], f"fleet_bronze_{name}")
    for name in silver.MODELS:
        tables.publish_view(c.silver[name], f"fleet_{name}")
    for name in gold.MODELS:
        tables.publish_view(c.gold[name], f"fleet_gold_{name}")
    return tables.layer_inventory(c.spark, "fleet_")


_EXPECTED = " ".join(f"WHEN '{layer}' THEN {size}" for layer, size in V.LAYER_SIZES.items())
query("metadata_count", _INVENTORY)(_inventory)
query("check_layer_inventory",
      f"SELECT layer, expected_relations, relations AS actual_relations, total_rows, {_status('relations = expected_relations')} "
      f"FROM (SELECT *, CAST(CASE layer {_EXPECTED} END AS INTEGER) AS expected_relations FROM ({_INVENTORY}))")(lambda c: V.check_layer_inventory(_inventory(c)))
