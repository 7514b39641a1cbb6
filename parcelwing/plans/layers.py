"""The three layers over a set of raw tables, built lazily and on demand."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from parcelwing import rules
from parcelwing.functions.text import Lexicon
from parcelwing.operators.joins import HOT_ROWS
from parcelwing.operators.windows import latest_per_key
from parcelwing.plans import gold, silver
from parcelwing.plans.bronze import live, to_bronze
from parcelwing.sources import tables
from parcelwing.sources.schemas import TABLES
from parcelwing.sources.versions import Staged

FEEDBACK = "silver_delivery_feedback"


class _Layer(Mapping):
    """Mapping whose DataFrames are built the first time they are asked for."""

    def __init__(self, names, build):
        self._names, self._build, self._built = tuple(names), build, {}
        self.crowded: dict[str, dict] = {}      # keys with very many rows, where they are known

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name not in self._names:
                raise KeyError(name)
            self._built[name] = self._build(name)
        return self._built[name]

    def replace(self, name: str, df: DataFrame) -> None:
        """Use a written table in place of the query that made it."""
        self._built[name] = df


class Layers:
    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        as_of: dt.datetime,
        load_ts: dt.datetime | None = None,
        lexicon: Lexicon = rules.SENTIMENT_LEXICON,
        newest: Collection[str] = (),
    ):
        """`newest` names the tables of which silver sees one row per key: the one loaded last."""
        self.raw, self.as_of = raw, as_of
        self.load_ts, self.lexicon = load_ts, lexicon
        self.bronze = _Layer(TABLES, lambda n: to_bronze(raw[n], n, load_ts))
        self.live = _Layer(TABLES, lambda n: self._once(n) if n in newest else live(self.bronze[n]))
        self.silver = _Layer(silver.MODELS, self._silver)
        self.gold = _Layer(gold.MODELS, self._gold)

    def _once(self, name: str) -> DataFrame:
        return latest_per_key(live(self.bronze[name]), [TABLES[name].key], ["_loaded_at"])

    def _silver(self, name: str) -> DataFrame:
        if name == FEEDBACK:
            return silver.delivery_feedback(self.live, self.as_of, self.lexicon)
        if name in silver.FROM_SILVER:
            return silver.FROM_SILVER[name](self.silver, self.as_of)
        return silver.FROM_BRONZE[name](self.live, self.as_of)

    def _gold(self, name: str) -> DataFrame:
        if name in gold.FROM_GOLD:
            return gold.FROM_GOLD[name](self.gold, self.as_of)
        return gold.FROM_SILVER[name](self.silver, self.as_of)


def refresh(spark: SparkSession, raw: Mapping[str, DataFrame], root: str, as_of: dt.datetime,
            load_ts: dt.datetime | None = None, lexicon: Lexicon = rules.SENTIMENT_LEXICON,
            hot_rows: int = HOT_ROWS) -> Layers:
    """Full refresh: write bronze, publish silver views, write gold.

    Scored feedback is written once, because two gold tables read the score.
    Each written table cuts the lineage, so a lost executor costs one table's work.
    All tables are staged before the first becomes visible, and a snapshot names
    the versions that belong together: a refresh that ends early changes nothing.
    Keys with more than `hot_rows` children are counted in the written bronze
    tables and kept with the scored feedback's version, for this and later joins.
    """
    layers = Layers(raw, as_of, load_ts, lexicon)
    staged: list[tuple[str, tables.VersionedTable, Staged]] = []

    def stage(layer: _Layer, folder: str, key: str, name: str) -> None:
        table = tables.stored_table(spark, root, folder, name)
        done = table.stage(layer[key], {"as_of": str(as_of), "crowded": layer.crowded})
        layer.replace(key, table.read_staged(done))
        staged.append((f"{folder}/{name}", table, done))

    for name in TABLES:
        stage(layers.bronze, "bronze", name, f"bronze_{name}")
    layers.silver.crowded = gold.crowded_parents(layers.bronze, hot_rows)
    stage(layers.silver, "silver", FEEDBACK, FEEDBACK)
    for name in gold.MODELS:
        stage(layers.gold, "gold", name, name)
    versions = {key: table.publish(done).number for key, table, done in staged}
    tables.publish_snapshot(spark, root, versions)
    for name in silver.MODELS:
        tables.publish_view(layers.silver[name], name)
    return layers
