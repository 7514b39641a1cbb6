"""Every pipeline stage on nulls, empty and very long texts, repeated rows, clashing columns and an empty table."""

from collections import Counter

import pytest
from conftest import EDGES

import corpus_pipeline

STAGES = dict(corpus_pipeline.STAGES)
FILTERS = [name for name, _ in corpus_pipeline.STAGES[:-1]]


@pytest.fixture(scope="module")
def labelled(spark, tmp_path_factory):
    """A folder with labels for some of the edge rows."""
    folder = str(tmp_path_factory.mktemp("tables"))
    labels = spark.createDataFrame([(1, 1, 0), (9, 0, 0), (12, 1, 0), (10, 0, 1), (14, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_columns_and_rows(spark, edges, nothing, labelled, name):
    kept = STAGES[name](spark, edges, labelled)
    assert kept.columns == edges.columns
    ids = Counter(i for i, _, _ in EDGES)
    got = Counter(r.doc_id for r in kept.collect())
    assert all(n <= ids[i] for i, n in got.items())
    empty = STAGES[name](spark, nothing, labelled)
    assert empty.columns == edges.columns and empty.count() == 0


def test_packing_takes_every_row(spark, edges, nothing, labelled):
    packed = STAGES["best_fit_packing"](spark, edges, labelled).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(i for i, _, _ in EDGES)
    assert STAGES["best_fit_packing"](spark, nothing, labelled).count() == 0


def test_run_over_an_empty_table(spark, nothing, labelled):
    nothing.write.mode("overwrite").parquet(f"{labelled}/documents.parquet")
    assert corpus_pipeline.run(spark, labelled).count() == 0
