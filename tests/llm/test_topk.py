"""Histogram selection against full sorting."""
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from regmine.llm import topk
from regmine.llm.queries import ORACLE, op3_exact_topk
from regmine.plans.verify import compare, duck_connect


def brute(rows, k, scale=256):
    import math
    good = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in good:
        if i % 3:
            continue
        found = sorted(((-sum(a * b for a, b in zip(q, c)), j) for j, c in good if j != i and len(c) == len(q)))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out)


def run(spark, rows, k):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, g int")
    out = topk.top_k(df.repartition(3), F.col("vec_id") % 3 == 0, k).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out)


def test_ties_duplicates_bad_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    r = random.Random(1)
    rows = [(i, [r.uniform(-1, 1) for _ in range(6)]) for i in range(60)]
    rows += [(100 + i, [0.5] * 6) for i in range(40)]                      # a hot vector: ties
    rows += [(7, [0.1] * 6), (9, None), (12, [float("nan")] * 6), (15, [None] * 6), (None, [0.1] * 6),
             (18, [0.25, 0.5]), (21, [1.0, 2.0]), (24, [1e6, -1e6]), (27, [3.0])]
    for k in (1, 5, 200):
        assert run(spark, rows, k) == brute(rows, k)


def test_repeated_query_rows_and_empty(spark):
    rows = [(0, [1.0]), (0, [2.0]), (1, [1.0]), (2, [3.0])]
    assert run(spark, rows, 5) == brute(rows, 5)
    assert run(spark, [(1, [1.0])], 5) == []
    assert run(spark, [], 5) == []
    assert run(spark, [(0, [0.0]), (1, [0.0])], 5) == [(0, 1, 1, 0)]


def test_query_against_sql(spark, sf):
    r = compare(op3_exact_topk(spark, sf), ORACLE["op3_exact_topk"], duck_connect(sf))
    assert r["match"], r


def test_a_batch_of_block_pairs_is_not_unpacked_at_once():
    vec = np.array([[1, 2], [3, 4]], dtype="<i2").tobytes()
    ids = np.array([5, 6], dtype="<i8").tobytes()
    row = {"dim": 2, "n": 2, "ids": ids, "vecs": vec, "kind": "<i2", "qb": 9, "q_n": 2, "q_ids": ids, "q_vecs": vec,
           "q_kind": "<i2", "state": [{"qi": 1, "lo": -7, "need": 3}, {"qi": 0, "lo": 4, "need": 2}]}
    batch = pa.RecordBatch.from_pylist([row, {**row, "qb": 10, "state": [{"qi": 1, "lo": 1, "need": 1}]}])

    class Columns:                                   # a batch that can be read row by row only
        schema, num_rows, column = batch.schema, batch.num_rows, batch.column

    a, b = topk._pairs([Columns])
    assert (a[0], a[1].tolist(), a[3].tolist(), a[4].tolist()) == (9, [5, 6], [4, -7], [2, 3])
    assert (b[0], b[3].tolist(), b[4].tolist(), b[6].tolist()) == (10, [0, 1], [0, 1], [[1, 2], [3, 4]])
