"""Quality classifier on supervised subword embeddings (operator 9).

Features of a text are its words and the character 3- and 4-grams of its words
(white space marks word ends), hashed into one embedding table.  A document is
the average of its features' vectors; a softmax layer gives the label
probabilities.  Vectors and layer are trained together by numpy stochastic
gradient descent on a bounded sample of labelled rows (``TRAIN_ROWS``, spread
evenly over the classes, chosen by a hash of id and text; rows equal in both count
once, so repeated ids keep the bound).  The log of each class's
learnable rows per sampled row goes into the bias, so the prior is that of all
learnable rows whatever their number.

With the two-class softmax, averaging commutes with the layer: each bucket
contributes one number, so scoring a text is the mean of a table lookup.  It is
one narrow pass over all rows and whole texts, long ones block by block.

Null and empty texts have no features and get the score of the bias.  With no
labelled row of either class the score is 0.5.  Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regmine.llm.common import id_and_text, id_type, texts_of, write_shared

BUCKETS = 1 << 17            # hashed feature vectors
WIDTH = 16                   # embedding size
TRAIN_ROWS = 3000            # labelled rows used per class (about)
EPOCHS = 6
RATE = 0.5
THRESHOLD = 0.7
BLOCK = 1 << 16              # code points at a time; blocks end at white space if there is some
SEED = 11

_POWERS = np.cumprod(np.full(256, 0x100000001B3, dtype=np.uint64))


def _hash_block(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    space = (c <= np.uint64(32)) | (c == np.uint64(0xA0)) | (c == np.uint64(0x3000))
    h = np.where(space, np.uint64(1), (c + np.uint64(7)) * np.uint64(0x9E3779B97F4A7C15))
    out = []
    if len(c) >= 3:
        g3 = h[:-2] * np.uint64(0xBF58476D1CE4E5B9) + h[1:-1] * np.uint64(0x94D049BB133111EB) + h[2:] * np.uint64(31)
        inner = space[1:-1]                       # a gram may begin or end, not run over, white space
        out.append(g3[~inner] + np.uint64(3))
        if len(c) >= 4:
            g4 = g3[:-1] * np.uint64(0xD6E8FEB86659FD93) + h[3:]
            out.append(g4[~(inner[:-1] | space[2:-1])] + np.uint64(4))
    word = ~space
    start = np.flatnonzero(word & np.concatenate([[True], space[:-1]]))
    if len(start):
        at = np.arange(len(c))
        first = np.zeros(len(c), dtype=np.int64)
        first[start] = start
        within = (at - np.maximum.accumulate(first)) % 256
        out.append(np.add.reduceat(np.where(word, h * _POWERS[within], np.uint64(0)), start) + np.uint64(1))
    if not out:
        return np.zeros(0, dtype=np.int64)
    g = np.concatenate(out) * np.uint64(0x2545F4914F6CDD1D)
    return (g >> np.uint64(47)).astype(np.int64)


def features(text: str | None):
    """Bucket numbers of a text's words and n-grams, in blocks."""
    low = (text or "").lower()
    at = 0
    while at < len(low):
        end = min(len(low), at + BLOCK)
        if end < len(low):
            cut = max(low.rfind(" ", at, end), low.rfind("\n", at, end))
            end = cut + 1 if cut > at else end
        got = _hash_block(low[at:end])
        if len(got):
            yield got
        at = end


class SubwordModel:
    """Bucket margins (label 1 against 0) and bias."""

    def __init__(self, margin: np.ndarray, bias: float):
        self.margin, self.bias = margin, bias

    def score(self, text: str | None) -> float:
        total, n = 0.0, 0
        for f in features(text):
            total += float(self.margin[f].sum())
            n += len(f)
        z = self.bias + (total / n if n else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def prior_shift(samples: list, totals: dict) -> float:
    """What sampling took from the log-odds of label 1: the classes' log ratio
    in the corpus (``totals``, rows per label) less that of the sample."""
    sampled = {y: sum(s[0] == y for s in samples) for y in (0, 1)}
    return float(np.log(totals[1] / sampled[1]) - np.log(totals[0] / sampled[0]))


def fit(samples: list, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED,
        totals: dict | None = None) -> SubwordModel:
    """samples: (label 0/1, buckets, counts) in a fixed order.  The prior is
    that of ``totals`` (rows per label), without it that of the sample."""
    if not samples or len({s[0] for s in samples}) < 2:
        return SubwordModel(np.zeros(BUCKETS, np.float32), 0.0)
    shift = prior_shift(samples, totals) if totals else 0.0
    rng = np.random.default_rng(seed)
    table = (rng.random((BUCKETS, WIDTH), dtype=np.float32) - 0.5) / WIDTH
    layer = np.zeros((2, WIDTH), dtype=np.float32)
    bias = np.zeros(2, dtype=np.float32)
    steps, total = 0, epochs * len(samples)
    shares = [(y, at, (n / n.sum()).astype(np.float32)) for y, at, n in samples if len(at)]
    for _ in range(epochs):
        for j in rng.permutation(len(shares)):
            y, at, w = shares[j]
            lr = rate * (1 - steps / total)
            rows = table[at]
            mean = w @ rows
            z = layer @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1                                    # gradient of the loss
            back = p @ layer
            layer -= lr * np.outer(p, mean)
            bias -= lr * p
            # the gradient of each bucket's vector, weighted by its share; the
            # factor keeps long texts' many small shares moving
            table[at] = rows - (lr * np.sqrt(len(at))) * np.outer(w, back)
            steps += 1
    return SubwordModel((table @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]) + shift)


def train(docs: DataFrame, labels: DataFrame, learnable, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", rows_per_class: int = TRAIN_ROWS) -> SubwordModel:
    """Fit on the labelled rows where ``learnable`` (a column of ``docs``)
    holds.  A document with several labels counts once for each."""
    lab = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("y")).where(
        F.col("y").isin(0, 1) & F.col("_id").isNotNull())
    text = docs.where(learnable & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    text = text.withColumn("h", F.xxhash64(F.col("doc_id").cast("string"), "text"))
    # learnable labels of the whole corpus, ids and hashes only
    known = text.select("doc_id", "h").join(lab, text["doc_id"] == lab["_id"]).select("doc_id", "h", "y")
    per = known.groupBy("y").agg(F.count("*").alias("n"), F.approx_count_distinct("h").alias("different")).collect()
    if len(per) < 2:
        return fit([])
    n = {r["y"]: r["n"] for r in per}
    share = F.create_map(*[F.lit(x) for r in per
                           for x in (r["y"], int(min(1.0, rows_per_class / r["different"]) * (1 << 30)))])
    # about 2 * rows_per_class rows whatever the tables hold, so they may be broadcast
    picked = write_shared(known.where(F.pmod("h", F.lit(1 << 30)) < share[F.col("y")]).distinct(), "quality-sample")
    rows = (text.join(F.broadcast(picked), ["doc_id", "h"]).groupBy("y", "h").agg(F.max("text").alias("text"))
            .select("y", "h", "text"))

    def vectorise(batches):
        for b in batches:
            y, h, at, count = [], [], [], []
            for label, key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts_of(b.column(2))):
                total = np.zeros(BUCKETS, dtype=np.int32)
                for f in features(text):
                    total += np.bincount(f, minlength=BUCKETS).astype(np.int32)
                nz = np.flatnonzero(total)
                y.append(label)
                h.append(key)
                at.append(nz.astype(np.int32))
                count.append(total[nz])
            yield pa.RecordBatch.from_arrays(
                [pa.array(y, pa.int32()), pa.array(h, pa.int64()), pa.array(at, pa.list_(pa.int32())),
                 pa.array(count, pa.list_(pa.int32()))], names=["y", "h", "at", "count"])

    got = rows.mapInArrow(vectorise, "y int, h bigint, at array<int>, count array<int>").toArrow().combine_chunks()
    y, h = (got.column(i).to_numpy() for i in (0, 1))
    at, count = got.column(2), got.column(3)
    order = np.lexsort((y, h))
    return fit([(int(y[i]), np.asarray(at[i].values, dtype=np.int64), np.asarray(count[i].values, dtype=np.float32))
                for i in order.tolist()], totals=n)


def score(docs: DataFrame, model: SubwordModel, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, score (0 to 1), predicted (score >= threshold)."""
    src = id_and_text(docs, id_col, text_col)

    def run(batches):
        for b in batches:
            s = [model.score(t) for t in texts_of(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(s, pa.float64()), pa.array([int(x >= threshold) for x in s], pa.int32())],
                names=["doc_id", "score", "predicted"])

    return src.mapInArrow(run, f"doc_id {id_type(src)}, score double, predicted int")
