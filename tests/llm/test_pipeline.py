"""The corpus pipeline, stage by stage, on a planted corpus and on a table."""
import corpus_pipeline
from regmine.llm.common import write_shared

from .test_jaccard import brute as near_brute
from .test_secrets import all_spans


def test_stages_on_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "secrets", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        new = write_shared(stage(spark, docs, sf), f"test-{name}")
        if name != "packing":
            assert new.columns == docs.columns
            after = {r.doc_id: r.text for r in new.collect()}
            assert new.count() == len(after) and set(after) <= set(before)
        if name == "exact_dedup":
            low = {}
            for i, t in before.items():
                key = (t or "").encode().lower()
                low[key] = max(i, low.get(key, i))
            assert set(after) == set(low.values())
        if name == "near_dedup":
            assert set(after) == {i for i, _, c in near_brute(sorted(before.items())) if i == c}
        if name == "secrets":
            for i, t in before.items():
                assert (after[i] == t) == (not all_spans(t or "")[1])
        if name == "packing":
            assert {r.doc_id for r in new.collect()} == set(before)
        docs = new


def test_query_runs_whole(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns)
