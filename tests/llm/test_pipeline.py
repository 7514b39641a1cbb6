"""Each stage of the pipeline on its own input, against plain Python."""

import brute
from test_contracts import check_packed

import corpus_pipeline
from parcelwing.llm.common import stored


def test_stages(spark, folder, rows):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "quality_rules", "jaccard_join", "best_fit_packing"]
    labels = {r["doc_id"]: r["quality"] for r in rows("labels")}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        after = stored(stage(spark, docs, folder), name)
        if name != "best_fit_packing":
            assert after.columns == docs.columns
            ids = sorted(r.doc_id for r in after.collect())
        if name == "quality_classifier":
            known = [i for i, _, _ in before if i in labels]
            assert sum((i in set(ids)) == (labels[i] == 1) for i in known) >= 0.93 * len(known)
        elif name == "quality_rules":
            assert ids == sorted(i for i, keep in brute.kept(before) if keep)
        elif name == "jaccard_join":
            groups = brute.components([(i, t) for i, t, _ in before], 5, 80)
            assert ids == sorted(i for i, (_, first) in groups.items() if i == first)
        else:
            check_packed([r.asDict() for r in after.collect()], [(i, t) for i, t, _ in before])
        docs = after
