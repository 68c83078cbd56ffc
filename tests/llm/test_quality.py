"""Held-out quality of the subword classifier and edge cases."""
import zlib

import numpy as np
from pyspark.sql import functions as F

from regmine.llm import quality
from regmine.llm.queries import op9_quality_classifier

SF_MID = "/root/testdata/sf0.01"


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    pos = label == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_query_held_out(spark):
    out = {r.doc_id: r for r in op9_quality_classifier(spark, SF_MID).collect()}
    assert len(out) == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    s, y = [], []
    for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect():
        o = out[r.doc_id]
        assert o.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert o.predicted == int(o.score >= 0.7) and 0 <= o.score <= 1
        if o.held_out and r.quality is not None:
            s.append(o.score)
            y.append(r.quality)
    assert auc(np.array(s), np.array(y)) > 0.95


def test_blocks_do_not_change_a_score(monkeypatch):
    rng = np.random.default_rng(1)
    model = quality.SubwordModel(rng.normal(size=quality.BUCKETS).astype(np.float32), 0.1)
    text = "some words, and more words\nin lines " * 50
    whole = model.score(text)
    monkeypatch.setattr(quality, "BLOCK", 64)
    assert abs(model.score(text) - whole) < 0.02


def test_edges(spark, sf, make_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(docs, labels, F.lit(True))
    rows = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "word " * 100_000), (5, "   ")]
    out = quality.score(make_docs(rows), model).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert quality.score(make_docs(rows).limit(0), model).count() == 0
    one = quality.train(docs, labels.where("quality = 1"), F.lit(True))
    assert {r.score for r in quality.score(make_docs(rows), one).collect()} == {0.5}


def test_prior_is_the_corpus_whatever_the_sample(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet").where("quality IS NOT NULL")
    learnable = F.col("doc_id") % 4 != 2
    n = {r.quality: r["count"] for r in labels.where(learnable).groupBy("quality").count().collect()}
    assert n[1] > 3 * n[0]
    seen, fit = {}, quality.fit

    def spy(samples, **kw):
        seen["model"], seen["samples"], seen["kw"] = fit(samples, **kw), samples, kw
        return seen["model"]

    monkeypatch.setattr(quality, "fit", spy)
    full = quality.train(docs, labels, learnable)
    every = seen["samples"]
    assert {y: sum(s[0] == y for s in every) for y in n} == n
    low = quality.train(docs, labels, learnable, rows_per_class=n[0])
    sampled = {y: sum(s[0] == y for s in seen["samples"]) for y in n}
    assert sampled[1] < 2 * sampled[0]
    assert seen["kw"]["totals"] == n                           # held-out labels do not count

    def mean_margin(model):
        return model.bias + np.mean([model.margin[at] @ c / c.sum() for _, at, c in every if len(at)])

    flat = fit(seen["samples"])                                # the classes as the sample has them
    assert abs(mean_margin(low) - mean_margin(full)) < 0.5 * abs(mean_margin(flat) - mean_margin(full))


def test_repeated_ids_keep_the_bound(spark, make_docs, monkeypatch):
    seen, fit = [], quality.fit
    monkeypatch.setattr(quality, "fit", lambda samples, **kw: seen.append((len(samples), kw)) or fit(samples, **kw))
    docs = make_docs([(i % 2, f"text number {i} of its kind") for i in range(2000)])
    labels = spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, quality int")
    quality.train(docs, labels, F.lit(True), rows_per_class=100)
    assert 100 <= seen[-1][0] <= 300 and seen[-1][1]["totals"] == {0: 1000, 1: 1000}
    same = make_docs([(i % 2, f"one text of {i % 2}") for i in range(2000)])
    quality.train(same, labels, F.lit(True), rows_per_class=100)
    assert seen[-1][0] == 2 and seen[-1][1]["totals"] == {0: 1000, 1: 1000}
