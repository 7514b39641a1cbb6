"""Frequent lines leave the text, in the operator and in the pipeline's stage."""

import corpus_pipeline
from parcelwing.llm import line_rules

STORY = "words {0} of a tale {0} that nobody else tells {0} in quite this way {0} and which goes on {0} for long {0} enough"


def docs_of(spark, rows):
    from parcelwing.llm.common import importable

    importable(spark)
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)


def test_frequent_lines_go(spark):
    rows = [(k, f"Share  this page\n\n{STORY.format(k)}\n \nshare THIS page \nlast {k}\n", "a") for k in range(30)]
    rows += [(40, f"Share this page\n{STORY.format(40)}", "b"), (41, None, "a"), (42, "", "a"), (43, "Share this page", "a")]
    docs = docs_of(spark, rows + rows[:1])
    want = {k: f"\n{STORY.format(k)}\n \nlast {k}\n" for k in range(30)} | {40: rows[30][1], 41: None, 42: "", 43: ""}
    got = line_rules.line_rules(docs).collect()
    assert len(got) == len(rows) + 1
    assert all(r.clean_text == want[r.doc_id] and r.text == dict((i, t) for i, t, _ in rows)[r.doc_id] for r in got)
    stage = corpus_pipeline.quality_rules(spark, docs, "").collect()
    assert sorted((r.doc_id, r.text) for r in stage) == sorted((k, want[k]) for k in [0, *range(30), 40])


def test_limit_on_large_hosts(spark, monkeypatch):
    """A line in few percent of a large host's texts still goes."""
    monkeypatch.setattr(line_rules, "MAX_LINE_DOCS", 20)
    rows = [(k, STORY.format(k) + ("\nnotice" if k < 21 else "\nrare" if k < 33 else ""), "a") for k in range(500)]
    got = {r.doc_id: r.clean_text for r in line_rules.line_rules(docs_of(spark, rows)).collect()}
    assert got == {k: STORY.format(k) + ("\nrare" if 21 <= k < 33 else "") for k in range(500)}
