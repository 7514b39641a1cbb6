"""Registration of queries with the SQL that verifies them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, VariantType

from parcelwing.catalog.domain_sql import compose
from parcelwing.plans.layers import Layers
from parcelwing.session import tune
from parcelwing.sources import adapter


class Context:
    """What a registered query may read: the test tables and the layers over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder
        self.raw = adapter.RawTables(spark, folder)
        self.layers = Layers(self.raw, adapter.AS_OF, adapter.LOAD_TS, adapter.TEST_LEXICON)
        self.bronze, self.silver, self.gold = self.layers.bronze, self.layers.silver, self.layers.gold

    def table(self, name: str) -> DataFrame:
        return self.raw.source(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Types that every engine hands over alike: dates as text, waypoints as numbers."""
    for field in df.schema:
        if isinstance(field.dataType, DateType):
            df = df.withColumn(field.name, F.col(field.name).cast("string"))
        elif isinstance(field.dataType, VariantType):
            middle = F.variant_get(field.name, "$[1].lat", "double")
            df = df.withColumn(f"{field.name}_mid_lat", middle).drop(field.name)
    return df


def query(name: str, sql: str | None = None, extra: dict[str, str] | None = None):
    """Register a function of a Context under a name, with its SQL if it has one."""

    def wrap(build: Callable[[Context], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(build(Context(spark, folder)))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = compose(sql, extra)
        return build

    return wrap
