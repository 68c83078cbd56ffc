"""Hard-negative mining by the threshold algorithm (operator 12).

Candidates are packed into blocks; a block holds, for every dimension, the list of
its rows in rising order of that component.  An anchor reads the lists by sorted
access, from the top where its own component is positive and from the bottom where
it is negative; rows met for the first time are scored by random access (exact
integer inner product).  The threshold is the score that a row not met yet could
reach at most, the sum over dimensions of the anchor's component times the last
value read.  Reading stops once the threshold is strictly below the kth score of
every window still open (or below its lowest admissible score), so that ties are
read to the end.

Two rounds, each the stated anchors against all rows in blocks: the first finds
each anchor's positives in lists of its own label, the second its negatives in
lists of the other labels, one window for each distinct positive score.  A task
carries its best lists from block to block and gives them out once; they are
merged by rank.

Rows of one label and vector have equal scores with any anchor, so only the
smallest ids of such a group (one more than can be asked for, each with the
number of its rows) go on, which cuts a group of copies of any size to a few
entries without changing a result.

Rows with a null id, a null label, a null vector or a null or non-finite component
take no part; vectors of different lengths have no score with each other.  "Other
rows" are those of another id.  Repeated rows count as often as they occur as
positives and negatives; an anchor repeated with the same label and vector is one
anchor.  Ties go to the smaller id.  An anchor without positives or without a
negative in a window gives no rows for it; neither does an empty table.  Scaled
components beyond 2^52 and scores beyond 2^56 are clipped.  Other columns, of
whatever name, are left behind.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regmine.llm.common import write_shared
from regmine.llm.vectors import by_length, integer_vectors

CANDIDATE_BLOCK = 4096       # entries per candidate block
ANCHOR_BLOCK = 512           # anchors per anchor block
FIRST = 16                   # rows read from every list in the first step; doubled from step to step
SCORE_LIMIT = 2 ** 56
BELOW = -(2 ** 62)           # below every score


# ---- the threshold algorithm on one block -----------------------------------

def exact_scores(x: np.ndarray, a: np.ndarray):
    """Integer inner products of the rows of x with a (clipped beyond 2^56)."""
    if float(np.abs(x).max(initial=0)) * float(np.abs(a).max(initial=0)) * max(1, len(a)) < 2.0 ** 53:
        return (x.astype(np.float64) @ a.astype(np.float64)).astype(np.int64)
    return np.clip(x.astype(object) @ a.astype(object), -SCORE_LIMIT, SCORE_LIMIT).astype(np.int64)


def threshold_scan(x: np.ndarray, lists: np.ndarray, anchor: np.ndarray, take) -> int:
    """Read the block (x: rows, lists: per dimension the row numbers by rising
    component) until ``take(rows, scores, threshold)`` says that no row scoring
    at most the threshold matters.  Returns how many rows were scored."""
    m = len(x)
    live = np.flatnonzero(anchor)
    if not m:
        return 0
    if not len(live):
        take(np.arange(m), np.zeros(m, dtype=np.int64), BELOW)
        return m
    walk = np.where(anchor[live, None] > 0, lists[live, ::-1], lists[live])
    seen = np.zeros(m, dtype=bool)
    depth, step, scored = 0, FIRST, 0
    while depth < m:
        end = min(m, depth + step)
        met = np.zeros(m, dtype=bool)
        met[walk[:, depth:end]] = True
        new = np.flatnonzero(met & ~seen)
        seen |= met
        scored += len(new)
        if scored == m:
            threshold = BELOW
        else:
            last = x[walk[:, end - 1], live]
            threshold = int(exact_scores(last[None, :], anchor[live])[0])
        if take(new, exact_scores(x[new], anchor), threshold):
            break
        depth, step = end, 2 * step
    return scored


class Best:
    """The first k (score, id) rows, higher scores first, ties by smaller id,
    among scores from ``low`` to ``high``."""
    __slots__ = ("k", "low", "high", "rows")

    def __init__(self, k: int, low: int = BELOW, high: int = -BELOW):
        self.k, self.low, self.high, self.rows = k, low, high, []

    @property
    def least(self) -> int:
        """Scores below it cannot come in any more."""
        return max(self.low, self.rows[-1][0]) if len(self.rows) == self.k else self.low

    def add(self, entries, scores, block, own: int) -> None:
        """Rows of the entries, not those of the anchor's own id."""
        ok = (scores >= self.least) & (scores <= self.high)
        if ok.any():
            got = [(int(s), i) for e, s in zip(entries[ok].tolist(), scores[ok].tolist())
                   for i, n in block.ids[e] if i != own for _ in range(min(n, self.k))]
            self.rows = sorted(self.rows + got, key=lambda r: (-r[0], r[1]))[:self.k]


class Block:
    """A candidate block and its lists, for the entries of some labels only."""

    def __init__(self, row: dict):
        n, d = row["c_n"], row["d"]
        self.x = np.frombuffer(row["c_vecs"], dtype=row["c_kind"]).reshape(n, d)
        self.lists = np.frombuffer(row["lists"], dtype="<i4").reshape(d, n)
        self.labels = row["c_labels"]
        self.label = np.frombuffer(row["c_label"], dtype="<i4")
        ends = np.cumsum(row["c_sizes"])
        pairs = list(zip(row["c_ids"], row["c_counts"]))
        self.ids = [pairs[e - s:e] for s, e in zip(row["c_sizes"], ends.tolist())]

    def of(self, label: str, same: bool):
        """(entries, their vectors, their lists) with that label, or without it."""
        code = self.labels.index(label) if label in self.labels else -1
        ok = (self.label == code) == same
        if ok.all():
            return np.arange(len(ok)), self.x, self.lists
        place = np.cumsum(ok) - 1
        kept = self.lists[ok[self.lists]].reshape(len(self.lists), int(ok.sum()))
        return np.flatnonzero(ok), self.x[ok], place[kept]


# ---- packing ------------------------------------------------------------------

def _kind(x: np.ndarray) -> str:
    top = int(np.abs(x).max(initial=0))
    return "<i2" if top < 2 ** 15 else "<i4" if top < 2 ** 31 else "<i8"


def _pack_rows(batches):
    """(vec_id, label, anchor, d, v): the vector as bytes of the narrowest kind
    that holds it, so that equal vectors are equal bytes."""
    for b in batches:
        for d, at, x in by_length(b.column(1)):
            kinds = [_kind(r) for r in x]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at)), b.column(2).take(pa.array(at)), b.column(3).take(pa.array(at)),
                 pa.array(np.full(len(at), d), pa.int32()),
                 pa.array([k[2].encode() + r.astype(k).tobytes() for k, r in zip(kinds, x)], pa.binary())],
                names=["vec_id", "label", "anchor", "d", "v"])


def _matrix(packed: list) -> np.ndarray:
    return np.stack([np.frombuffer(v, dtype=f"<i{v[:1].decode()}", offset=1).astype(np.int64) for v in packed])


def _by_dimension(batches, size: int):
    """Lists of at most ``size`` rows (dicts) of one vector length."""
    rest: dict = {}
    for b in batches:
        for r in b.to_pylist():
            rows = rest.setdefault(r["d"], [])
            rows.append(r)
            if len(rows) == size:
                yield rest.pop(r["d"])
    yield from rest.values()


CANDIDATES = ("d int, c_n int, c_kind string, c_vecs binary, lists binary, c_labels array<string>, c_label binary, "
              "c_sizes array<int>, c_ids array<bigint>, c_counts array<bigint>")
ANCHORS = "d int, a_n int, a_kind string, a_vecs binary, a_labels array<string>, a_ids array<bigint>"


def _candidate_blocks(size: int):
    def run(batches):
        for rows in _by_dimension(batches, size):
            x = _matrix([r["v"] for r in rows])
            kind, labels = _kind(x), sorted({r["label"] for r in rows})
            code = {v: i for i, v in enumerate(labels)}
            yield pa.RecordBatch.from_pylist([{
                "d": rows[0]["d"], "c_n": len(rows), "c_kind": kind, "c_vecs": x.astype(kind).tobytes(),
                "lists": np.argsort(x, axis=0, kind="stable").T.astype("<i4").tobytes(), "c_labels": labels,
                "c_label": np.array([code[r["label"]] for r in rows], dtype="<i4").tobytes(),
                "c_sizes": [len(r["ids"]) for r in rows], "c_ids": [e["vec_id"] for r in rows for e in r["ids"]],
                "c_counts": [e["n"] for r in rows for e in r["ids"]]}], schema=_arrow(CANDIDATES))

    return run


def _anchor_blocks(size: int):
    def run(batches):
        for rows in _by_dimension(batches, size):
            rows.sort(key=lambda r: r["label"])
            x = _matrix([r["v"] for r in rows])
            yield pa.RecordBatch.from_pylist([{
                "d": rows[0]["d"], "a_n": len(rows), "a_kind": _kind(x), "a_vecs": x.astype(_kind(x)).tobytes(),
                "a_labels": [r["label"] for r in rows], "a_ids": [r["vec_id"] for r in rows]}],
                schema=_arrow(ANCHORS))

    return run


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "bigint": pa.int64(),
             "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32()),
             "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


# ---- meeting of anchors and candidates ------------------------------------------

def _meet(same: bool, open_windows, out: pa.Schema):
    """Scan every candidate block for every anchor of the anchor block beside it.
    ``open_windows(row)`` gives, per anchor, its windows {key: Best}."""
    def run(batches):
        held, state = None, None

        def give():
            rows = [(held, qi, key, i, s) for qi, windows in enumerate(state or []) for key, best in windows.items()
                    for s, i in best.rows]
            cols = list(zip(*rows)) if rows else [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, out.types)], schema=out)

        for b in batches:
            for r in (row for i in range(b.num_rows) for row in b.slice(i, 1).to_pylist()):
                if r["qb"] != held:
                    if state:
                        yield give()
                    held, state = r["qb"], open_windows(r)
                anchors = np.frombuffer(r["a_vecs"], dtype=r["a_kind"]).reshape(r["a_n"], r["d"]).astype(np.int64)
                block = Block(r)
                for label, group in groupby(range(r["a_n"]), key=r["a_labels"].__getitem__):
                    entries, x, lists = block.of(label, same)
                    for qi in group:
                        windows, own = state[qi], r["a_ids"][qi]
                        if not windows or not len(entries):
                            continue

                        def take(rows, scores, threshold):
                            some = entries[rows]
                            for best in windows.values():
                                best.add(some, scores, block, own)
                            return all(threshold < best.least for best in windows.values())

                        threshold_scan(x, lists, anchors[qi], take)
        if state:
            yield give()

    return run


def hard_negatives(vectors: DataFrame, label: Column, is_anchor: Column, positives: int = 5, negatives: int = 10,
                   low: int = 30, high: int = 90, scale: float = 256.0, id_col: str = "vec_id",
                   vec_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score):
    for each row where ``is_anchor`` holds and each of its best ``positives``
    rows of the same label, the best ``negatives`` rows of another label with
    low % <= negative_score / positive_score <= high %."""
    spark = vectors.sparkSession
    src = integer_vectors(vectors, id_col, vec_col, scale, label.cast("string").alias("label"),
                          is_anchor.alias("anchor")).select(F.col("vec_id").cast("bigint").alias("vec_id"), "x",
                                                            "label", "anchor")
    rows = write_shared(src.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("x") > 0))
                        .mapInArrow(_pack_rows, "vec_id bigint, label string, anchor boolean, d int, v binary"),
                        "mining-rows")
    # the smallest ids of each label and vector, with their numbers of rows
    first = Window.partitionBy("label", "d", "v").orderBy("vec_id")
    keep = max(positives, negatives) + 1
    entries = (rows.groupBy("label", "d", "v", "vec_id").agg(F.count("*").alias("n"))
               .withColumn("at", F.row_number().over(first)).where(F.col("at") <= keep)
               .groupBy("label", "d", "v").agg(F.sort_array(F.collect_list(F.struct("vec_id", "n"))).alias("ids")))
    cands = write_shared(entries.mapInArrow(_candidate_blocks(CANDIDATE_BLOCK), CANDIDATES)
                         .withColumn("g", F.monotonically_increasing_id()), "mining-candidates")
    anchors = write_shared(rows.where("anchor").select("vec_id", "label", "d", "v").distinct()
                           .mapInArrow(_anchor_blocks(ANCHOR_BLOCK), ANCHORS)
                           .withColumn("qb", F.monotonically_increasing_id()), "mining-anchors")

    # candidate blocks are dealt to buckets, anchor blocks go to every bucket.  The
    # planner takes the copies for as small as one (compressed) anchor table, so
    # the merge hints keep them from being broadcast through the driver
    buckets = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), cands.count()))
    dealt = cands.withColumn("bucket", F.pmod(F.hash("g"), F.lit(buckets))).drop("g")
    every = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket")

    def meet(sent, same, windows, out):
        pairs = sent.select("*", every).join(dealt.hint("merge"), ["bucket", "d"]).sortWithinPartitions("qb")
        return pairs.mapInArrow(_meet(same, windows, out), ", ".join(f"{f.name} bigint" for f in out))

    found = pa.schema([(c, pa.int64()) for c in ("qb", "qi", "window", "id", "score")])
    best = Window.partitionBy("qb", "qi", "window").orderBy(F.col("score").desc(), "id")
    near = meet(anchors, True, lambda r: [{0: Best(positives)} for _ in range(r["a_n"])], found)
    near = near.withColumn("at", F.row_number().over(best)).where(F.col("at") <= positives)
    near = write_shared(near.select("qb", "qi", F.col("id").alias("positive_id"), F.col("score").alias("window")),
                        "mining-positives")

    def windows(r):
        out = [{} for _ in range(r["a_n"])]
        for w in r["asked"]:
            s = w["window"]
            if s >= 0:                                # else the bounds exclude each other
                out[w["qi"]][s] = Best(negatives, -(-low * s // 100), high * s // 100)
        return out

    # at most ANCHOR_BLOCK * positives windows a block
    asked = near.select("qb", "qi", "window").distinct().groupBy("qb").agg(
        F.collect_list(F.struct("qi", "window")).alias("asked"))
    hard = meet(anchors.join(asked.hint("merge"), "qb"), False, windows, found)
    hard = hard.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    names = anchors.select("qb", F.posexplode("a_ids").alias("qi", "anchor_id"))
    return (hard.join(near, ["qb", "qi", "window"]).join(names, ["qb", "qi"])
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
                    F.col("window").alias("positive_score"), F.col("score").alias("negative_score")))
