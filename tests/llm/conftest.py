import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

FOLDER = os.environ.get("TEXT_TABLES", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def rows(spark):
    """Rows of one test table as dictionaries."""
    from parcelwing.llm.common import importable

    importable(spark)
    cache = {}

    def read(name):
        if name not in cache:
            cache[name] = [r.asDict() for r in spark.read.parquet(f"{FOLDER}/{name}.parquet").collect()]
        return cache[name]

    return read


EDGES = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta.", "a"), (2, "alpha BETA gamma delta epsilon zeta eta theta.", "a"),
    (3, None, "a"), (4, "", None), (5, " \t\n\r\x0b\x0c", "b"), (6, "one", "b"), (7, "one two", "b"), (7, "one two", "b"),
    (8, "é ü 日本語 \U0001f600 ok\n\nok\nok", None), (None, "no id here at all", "a"), (9, "wörd " * 30_000, "c"),
    (10, "x" * 50_000, "c"), (11, "two  spaces and nbsp \n tail ", "c"), (12, "<|endoftext|> don't we'll ~ '", "c"),
    (13, "Licensed under the Apache License, Version 2.0. CC BY, MIT License", "c"), (14, "\x1c\x85  odd　blanks", "c"),
    (15, "ok\nok\nok", "c"),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, empty and very long texts, repeats, ties, and extra columns named like results."""
    from parcelwing.llm.common import importable

    importable(spark)
    data = [(i, t, "en", s, None, "x", 1, True) for i, t, s in EDGES]
    return spark.createDataFrame(
        data, "doc_id long, text string, lang string, source string, n_chars long, n_words string, score int, kept boolean"
    ).repartition(3)


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.limit(0)
