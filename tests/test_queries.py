"""Every registered query against its SQL, on the smallest test tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_module  # noqa: E402
from compare import difference, open_oracle, oracle_rows, spark_rows  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    return open_oracle(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, oracle, name):
    got = spark_rows(QUERIES[name](spark, FOLDER))
    if name in ORACLE:
        assert difference(got, oracle_rows(oracle, ORACLE[name])) == ""
    else:
        assert sum(got[1].values()) > 0


def test_entry_is_the_flagship(spark):
    assert entry_module.entry(spark).columns[0] == "report_date"


def test_all_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)
