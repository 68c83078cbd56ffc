"""Threshold algorithm against full sorting."""
import math
import random

import numpy as np
from pyspark.sql import functions as F

from regmine.llm import mining
from regmine.llm.queries import ORACLE, op12_hard_negatives
from regmine.plans.verify import compare, duck_connect


def brute(rows, k_pos, k_neg, low, high):
    good = [(i, lab, [math.floor(256 * c) for c in v]) for i, lab, v in rows if i is not None and lab is not None
            and v and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for i, lab, q in sorted(set((i, lab, tuple(q)) for i, lab, q in good if i % 3 == 0)):
        scored = sorted((-sum(a * b for a, b in zip(q, c)), j, other) for j, other, c in good
                        if j != i and len(c) == len(q))
        for ps, pid, _ in [r for r in scored if r[2] == lab][:k_pos]:
            fit = [(j, -s) for s, j, other in scored if other != lab and low * -ps <= 100 * -s <= high * -ps]
            out += [(i, pid, r + 1, j, -ps, s) for r, (j, s) in enumerate(fit[:k_neg])]
    return sorted(out)


def run(spark, rows, k_pos=3, k_neg=4, low=30, high=90):
    df = spark.createDataFrame([(i, lab, v, 1, "x") for i, lab, v in rows],
                               "vec_id long, label int, embedding array<double>, rank int, x string")
    out = mining.hard_negatives(df.repartition(3), F.col("label"), F.col("vec_id") % 3 == 0, k_pos, k_neg, low, high)
    return sorted(map(tuple, out.collect()))


def test_ties_copies_bad_rows(spark, monkeypatch):
    monkeypatch.setattr(mining, "CANDIDATE_BLOCK", 16)
    monkeypatch.setattr(mining, "ANCHOR_BLOCK", 4)
    monkeypatch.setattr(mining, "FIRST", 2)
    r = random.Random(5)
    rows = [(i, r.randrange(3), [r.uniform(-0.2, 1) for _ in range(6)]) for i in range(70)]
    rows += [(100 + i, i % 2, [0.5] * 6) for i in range(60)]                 # a hot vector: ties
    rows += [(6, 1, rows[6][2])] * 7 + [(200, 2, [0.4] * 6)] * 5             # repeated rows
    rows += [(9, 1, None), (12, None, [0.1] * 6), (None, 1, [0.9] * 6), (15, 1, [float("nan")] * 6),
             (18, 0, [None] * 6), (21, 0, [0.0] * 6), (24, 0, [1.0, 2.0]), (25, 0, [1.0, 1.0]), (26, 1, [0.5, 1.0]),
             (27, 0, []), (30, 1, [1e5, 0.0]), (31, 1, [1e5, 1.0]), (32, 0, [5e4, 1.0])]
    assert run(spark, rows) == brute(rows, 3, 4, 30, 90)
    assert run(spark, rows, 2, 40, 0, 100) == brute(rows, 2, 40, 0, 100)


def test_few_rows_and_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, 1, [1.0])]) == []
    rows = [(0, 1, [1.0]), (1, 1, [1.0]), (2, 0, [0.5]), (3, 0, [0.95])]
    assert run(spark, rows) == brute(rows, 3, 4, 30, 90) != []
    zero = [(0, 1, [0.0]), (1, 1, [1.0]), (2, 0, [0.5])]
    assert run(spark, zero) == brute(zero, 3, 4, 30, 90) == [(0, 1, 1, 2, 0, 0)]


def test_reading_stops_early_and_ties_are_read():
    rng = np.random.default_rng(2)
    x = np.floor(256 * rng.standard_normal((4096, 2))).astype(np.int64)
    lists = np.argsort(x, axis=0, kind="stable").T
    anchor = np.array([200, -100])
    best = mining.Best(5)

    class One:
        ids = [[(i, 1)] for i in range(4096)]

    def take(rows, scores, threshold):
        best.add(rows, scores, One, -1)
        return threshold < best.least

    scored = mining.threshold_scan(x, lists, anchor, take)
    want = sorted(zip((x @ anchor).tolist(), range(4096)), key=lambda r: (-r[0], r[1]))[:5]
    assert best.rows == want and scored < 1000
    same = np.ones((300, 2), dtype=np.int64)
    best = mining.Best(5)
    assert mining.threshold_scan(same, np.tile(np.arange(300), (2, 1)), np.array([1, 1]), take) == 300
    assert [i for _, i in best.rows] == [0, 1, 2, 3, 4]


def test_query_against_sql(spark, sf):
    r = compare(op12_hard_negatives(spark, sf), ORACLE["op12_hard_negatives"], duck_connect(sf))
    assert r["match"], r


def test_clipped_scores(spark):
    got = run(spark, [(0, 1, [1e300, 1.0]), (1, 1, [1e200, 1.0]), (2, 0, [1.0, 1e9])])
    assert got == []                 # both scores are clipped to 2^56, beyond 90 %


def test_anchors_for_every_bucket_are_not_broadcast(spark):
    # one copy of the anchor blocks for each bucket: a broadcast would pass them all through the driver
    df = spark.createDataFrame([(i, i % 2, [i / 50, 1 - i / 50]) for i in range(50)],
                               "vec_id long, label int, embedding array<double>")
    out = mining.hard_negatives(df, F.col("label"), F.col("vec_id") % 3 == 0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [bucket" in plan and "BroadcastHashJoin [bucket" not in plan
    assert "a_vecs" not in "".join(x for x in plan.splitlines() if "BroadcastExchange" in x)
