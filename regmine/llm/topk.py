"""Exact top-k search by distributed histogram selection (operator 3).

Vectors are packed into blocks; every block of queries meets every block of
candidates once per pass (the stated query set against all rows, in blocks).
A pass scores everything and counts scores in a histogram per query, over the
interval that holds the query's kth value; the counts are added up globally, the
bin with the kth value becomes the next interval, and after a few passes the
interval is one number.  A last pass keeps the scores above it and, among those
equal to it, the smallest ids.

A task reports a query's bins from the top only until they hold as many scores
as are still looked for: lower bins of that task cannot hold the global kth
value, so the sums stay exact where it matters and the shuffle stays small.

Components become floor(scale * x); the score is the integer inner product,
exact while it fits 64 bits (beyond, it is clipped).  Rows with a null id, a
null vector or a null or non-finite component take no part; vectors of different
lengths have no score with each other.  "Its own row" means the same id; every
repeated row is a query and a candidate of its own.  Ties go to the smaller id.
Fewer than k candidates give them all; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regmine.llm.common import write_shared

BINS_LOG2 = 12               # histogram bins per pass
CANDIDATE_BLOCK = 4096       # vectors per candidate block
QUERY_BLOCK = 512            # queries per query block

BLOCK_SCHEMA = "dim int, n int, ids binary, vecs binary, kind string, norm2 double"


def _blocks(size: int, scale: float):
    def run(batches):
        rest: dict = {}

        def pack(dim, ids, vecs):
            top = np.abs(vecs).max(initial=0)
            kind = "<i2" if top < 2 ** 15 else "<i4" if top < 2 ** 31 else "<i8"
            norm2 = float((vecs.astype(np.float64) ** 2).sum(axis=1).max()) if len(ids) else 0.0
            return (dim, len(ids), ids.astype("<i8").tobytes(), vecs.astype(kind).tobytes(), kind, norm2)

        def emit(rows):
            cols = list(zip(*rows)) if rows else [[]] * 6
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.binary(), pa.binary(),
                                                       pa.string(), pa.float64()))],
                names=["dim", "n", "ids", "vecs", "kind", "norm2"])

        for b in batches:
            ids, vecs = b.column(0), b.column(1)
            good = np.asarray(ids.is_valid()) & np.asarray(vecs.is_valid())
            full = []
            for i in np.flatnonzero(good).tolist():
                v = vecs[i].values
                if v.null_count:
                    continue
                x = np.floor(scale * v.to_numpy(zero_copy_only=False).astype(np.float64))
                if not np.isfinite(x).all():
                    continue
                # int64 components; larger ones (beyond any real embedding) are clipped
                x = np.clip(x, -2.0 ** 62, 2.0 ** 62).astype(np.int64)
                a = rest.setdefault(len(x), ([], []))
                a[0].append(ids[i].as_py())
                a[1].append(x)
                if len(a[0]) == size:
                    full.append(pack(len(x), np.array(a[0], dtype=np.int64), np.stack(a[1])))
                    del rest[len(x)]
            yield emit(full)
        yield emit([pack(d, np.array(a, dtype=np.int64), np.stack(v)) for d, (a, v) in rest.items()])

    return run


def _unpack(ids: bytes, vecs: bytes, kind: str, n: int, dim: int):
    return np.frombuffer(ids, dtype="<i8"), np.frombuffer(vecs, dtype=kind).reshape(n, dim)


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products (clipped to 64 bits)."""
    a, b = float(np.abs(q).max(initial=0)), float(np.abs(c).max(initial=0))
    if a * b * max(1, q.shape[1]) < 2.0 ** 53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    big = q.astype(object) @ c.astype(object).T
    return np.clip(big, -2 ** 62, 2 ** 62).astype(np.int64)


def _pairs(batches):
    """(query block, state arrays, scores, candidate ids) per row of the join.
    One row is unpacked at a time: a batch holds many copies of large blocks."""
    for b in batches:
        at = {name: i for i, name in enumerate(b.schema.names)}
        for i in range(b.num_rows):
            r = {name: b.column(k)[i].as_py() for name, k in at.items() if name != "state"}
            qid, q = _unpack(r["q_ids"], r["q_vecs"], r["q_kind"], r["q_n"], r["dim"])
            cid, c = _unpack(r["ids"], r["vecs"], r["kind"], r["n"], r["dim"])
            lo, need = np.zeros(len(qid), dtype=np.int64), np.zeros(len(qid), dtype=np.int64)
            state = b.column(at["state"])[i].values
            qi, low, wanted = (state.field(x).to_numpy(zero_copy_only=False) for x in ("qi", "lo", "need"))
            lo[qi], need[qi] = low, wanted
            yield r["qb"], qid, cid, lo, need, q, c


def _histogram(shift: int, bins: int):
    def run(batches):
        for qb, qid, cid, lo, need, q, c in _pairs(batches):
            for at in range(0, len(qid), 128):
                some = slice(at, at + 128)
                s = _scores(q[some], c)
                rel = (s - lo[some, None]) >> shift
                m = len(rel)
                ok = (rel >= 0) & (rel < bins) & (qid[some, None] != cid[None, :]) & (need[some, None] > 0)
                row = np.broadcast_to(np.arange(m)[:, None], rel.shape)[ok]
                hist = np.bincount(row * bins + rel[ok], minlength=m * bins).reshape(m, bins)
                above = hist[:, ::-1].cumsum(axis=1)[:, ::-1] - hist      # counts in higher bins
                qi, bin_ = np.nonzero((hist > 0) & (above < need[some, None]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(qi), qb), pa.int64()), pa.array(qi + at, pa.int32()),
                     pa.array(bin_, pa.int64()), pa.array(hist[qi, bin_], pa.int64())],
                    names=["qb", "qi", "bin", "n"])

    return run


def _select(batches):
    """Scores above the kth value, and at it the smallest ids of this pair."""
    for qb, qid, cid, lo, need, q, c in _pairs(batches):
        order = np.argsort(cid, kind="stable")
        cid, c = cid[order], c[order]
        for at in range(0, len(qid), 128):
            some = slice(at, at + 128)
            s = _scores(q[some], c)
            live = (need[some, None] > 0) & (qid[some, None] != cid[None, :])
            tie = live & (s == lo[some, None])
            take = (live & (s > lo[some, None])) | (tie & (tie.cumsum(axis=1) <= need[some, None]))
            qi, ci = np.nonzero(take)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(qi), qb), pa.int64()), pa.array(qi + at, pa.int32()),
                 pa.array(qid[some][qi], pa.int64()), pa.array(cid[ci], pa.int64()), pa.array(s[qi, ci], pa.int64())],
                names=["qb", "qi", "query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query, k: int, scale: float = 256.0, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each row for
    which the column ``is_query`` holds, against all rows."""
    src = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"),
                         F.col(vec_col).cast("array<double>").alias("vec"), is_query.alias("is_query"))
    cands = write_shared(src.select("vec_id", "vec").mapInArrow(_blocks(CANDIDATE_BLOCK, scale), BLOCK_SCHEMA)
                         .where("n > 0").withColumn("g", F.monotonically_increasing_id()), "topk-candidates")
    queries = write_shared(src.where("is_query").select("vec_id", "vec")
                           .mapInArrow(_blocks(QUERY_BLOCK, scale), BLOCK_SCHEMA).where("n > 0")
                           .withColumn("qb", F.monotonically_increasing_id()), "topk-queries")
    norm2 = cands.agg(F.max("norm2")).first()[0]
    if norm2 is None:
        norm2 = 0.0
    bound = int(min(norm2 * (1 + 1e-9) + 1, 2.0 ** 62))           # |score| <= bound (Cauchy-Schwarz)
    bits = max(1, (2 * bound).bit_length())

    # where each query's kth value lies: (block, place in it, lowest value, how
    # many of the interval's scores are still wanted)
    state = queries.select("qb", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("qi"),
                           F.lit(-bound).cast("bigint").alias("lo"), F.lit(k).cast("bigint").alias("need"))
    # each query block goes to every candidate block of its vector length, by number
    places = cands.select("g", F.col("dim").alias("c_dim"))
    targets = places.groupBy("c_dim").agg(F.collect_list("g").alias("gs"))       # one row per length, block numbers
    aimed = (queries.select("qb", F.col("n").alias("q_n"), F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs"),
                            F.col("kind").alias("q_kind"), "dim")
             .join(targets, F.col("dim") == F.col("c_dim")).drop("c_dim", "dim"))

    def meet(state):
        # at most QUERY_BLOCK entries per block
        held = state.groupBy("qb").agg(F.collect_list(F.struct("qi", "lo", "need")).alias("state"))
        sent = aimed.join(held, "qb").withColumn("g", F.explode("gs")).drop("gs")
        # (a copy of a query block for each candidate block: never a broadcast)
        return cands.drop("norm2").join(sent.hint("merge"), "g").drop("g")

    shift = max(0, bits - BINS_LOG2)
    while True:
        counts = (meet(state).mapInArrow(_histogram(shift, 1 << (bits - shift)),
                                         "qb bigint, qi int, bin bigint, n bigint")
                  .groupBy("qb", "qi", "bin").agg(F.sum("n").alias("n")))
        down = Window.partitionBy("qb", "qi").orderBy(F.col("bin").desc())
        whole = Window.partitionBy("qb", "qi")
        want = F.least("need", "all")                    # fewer candidates than k: all of them
        found = (counts.withColumn("upto", F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, 0)))
                 .withColumn("all", F.sum("n").over(whole)).join(state, ["qb", "qi"])
                 .where((F.col("upto") - F.col("n") < want) & (want <= F.col("upto"))))
        state = write_shared(found.select(
            "qb", "qi", (F.col("lo") + F.col("bin") * (1 << shift)).alias("lo"),
            (want - F.col("upto") + F.col("n")).alias("need")), f"topk-state-{shift}")
        if shift == 0:
            break
        bits, shift = shift, max(0, shift - BINS_LOG2)
    best = meet(state).mapInArrow(_select, "qb bigint, qi int, query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("qb", "qi").orderBy(F.col("score").desc(), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
