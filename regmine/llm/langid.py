"""Language identification by nearest centroids (operator 2).

A text becomes a normalised TF-IDF vector of hashed character n-grams (1 to 3) of
its letters.  Each language has several centroids, the clusters of its training
vectors (spherical k-means, farthest-first start); a text takes the language of
the centroid with the highest cosine.  A text whose distance to its centroid is
beyond that centroid's radius is marked rejected.  Radii come from the cosines of
the centroid's own cluster, whose texts are also thinned to fewer n-grams: one per
band of the number of distinct n-grams (``BANDS``), wider for texts with few.

Training uses about ``TRAIN_PER_LANGUAGE`` labelled rows per language, chosen by a
hash of id and text (a documented bound; their vectors, not their texts, go to the
driver).  Rows equal in both count once, so repeated and null ids keep the bound.  Prediction is one narrow pass over all rows and whole texts.

Null texts and texts without a letter get ``und`` with score 0 and are rejected.
With no labelled row at all every text gets ``und``; those with a letter are not
rejected.  Ties go to the first
language by name.  Empty tables give no rows; repeated rows equal results.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regmine.llm.common import id_and_text, id_type

DIM = 1 << 13                # hashed n-gram features
TRAIN_PER_LANGUAGE = 400     # labelled rows used per language (about)
CENTROIDS = 4                # clusters per language
BANDS = (64, 256, 1024)      # distinct n-grams from which the second to fourth radius hold
SLACK = (0.2, 0.5, 0.5, 0.5)     # a text is rejected below this share of the lowest cosine of its band; the
                             # shortest texts are far from any centroid, other scripts much farther
THIN = (50, 150, 500, 1500)  # n-grams left in the thinned training texts (about)
LOW = 0.01                   # quantile taken as the lowest cosine, as a stray training text must not set a radius
FEW = 20                     # smaller clusters take the language's lowest cosines, their own are too high
BLOCK = 1 << 16              # code points hashed at a time
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    """Which code points of the basic plane are letters; beyond it all count."""
    return np.array([chr(i).isalpha() for i in range(1 << 16)] + [True])


def _letter_codes(block: str) -> np.ndarray:
    """Code points of ``block`` with every run of other characters as one space."""
    c = np.frombuffer(block.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _letters()[np.minimum(c, 1 << 16)]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    return np.where(letter, c, 32)[keep].astype(np.uint64)


def ngram_counts(text: str) -> np.ndarray:
    """Counts of hashed 1- to 3-grams of a whole text's letters (lower-cased,
    any run of other characters is one space), float32[DIM].  Long texts are
    hashed block by block, with two letters carried over."""
    out = np.zeros(DIM, dtype=np.int64)
    low = text.lower()
    carry = np.zeros(0, dtype=np.uint64)
    for at in range(0, len(low), BLOCK):
        skip = len(carry)
        c = np.concatenate([carry, _letter_codes(low[at:at + BLOCK])])
        carry = c[-2:]
        h1 = c * np.uint64(0x9E3779B97F4A7C15)
        grams = [h1[skip:]]
        if len(c) > 1:
            h2 = h1[:-1] * np.uint64(31) + h1[1:] * np.uint64(0xBF58476D1CE4E5B9)
            grams.append(h2[max(0, skip - 1):])
            if len(c) > 2:
                h3 = h2[:-1] * np.uint64(37) + h1[2:] * np.uint64(0x94D049BB133111EB)
                grams.append(h3[max(0, skip - 2):])
        for n, g in enumerate(grams):
            g = (g + np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)
            out += np.bincount((g >> np.uint64(51)).astype(np.int64), minlength=DIM)
    return out.astype(np.float32)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class CentroidModel:
    def __init__(self, idf, centroids, owner, radius, languages):
        self.idf, self.centroids, self.owner = idf, centroids, owner
        self.radius, self.languages = radius, languages

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        v = np.log1p(counts) * self.idf
        norm = np.linalg.norm(v, axis=1, keepdims=True)
        return v / np.where(norm > 0, norm, 1)

    def predict(self, texts: list):
        """(language, cosine, rejected) per text."""
        out = [(UNKNOWN, 0.0, True)] * len(texts)
        if not self.languages:
            return [(UNKNOWN, 0.0, not has_letter(t)) for t in texts]
        known = [i for i, t in enumerate(texts) if has_letter(t)]
        for at in range(0, len(known), 64):
            some = known[at:at + 64]
            counts = np.stack([ngram_counts(texts[i]) for i in some])
            cos = self.vectors(counts) @ self.centroids.T
            best = cos.argmax(axis=1)
            for i, b, c, band in zip(some, best, cos[np.arange(len(some)), best], bands(counts)):
                score = float(min(1.0, max(0.0, c)))
                out[i] = (self.languages[self.owner[b]], score, bool(1 - score > self.radius[b][band]))
        return out


def bands(counts: np.ndarray) -> np.ndarray:
    """Band of each row by its number of distinct n-grams."""
    return np.searchsorted(BANDS, (counts > 0).sum(axis=1), side="right")


def _radii(model: CentroidModel, counts: np.ndarray, c: np.ndarray) -> list:
    """Radius per band of each centroid of a language, from its training texts
    (``counts``), whole and thinned."""
    rng = np.random.default_rng(5)
    near = (model.vectors(counts) @ c.T).argmax(axis=1)
    total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    seen = []
    for m in (None, *THIN):
        some = counts if m is None else rng.binomial(counts.astype(np.int64), np.minimum(1, m / total)).astype(np.float32)
        ok = some.any(axis=1)
        seen.append(np.stack([near, bands(some), (model.vectors(some) * c[near]).sum(axis=1)], axis=1)[ok])
    cluster, band, cos = np.concatenate(seen).T
    few = np.bincount(near, minlength=len(c)) < FEW
    low = np.full((len(c), len(SLACK)), np.inf)
    for j in range(len(c)):
        for k in range(len(SLACK)):
            own = cos[(band == k) & ((cluster == j) | few[j])]
            if len(own):
                low[j, k] = np.quantile(own, LOW)
    # fewer n-grams never have the narrower radius; a band no text is in has that of the one below
    for k in range(1, len(SLACK)):
        low[:, k] = np.where(np.isinf(low[:, k]), low[:, k - 1], low[:, k])
    low = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1]
    return [[float(1 - s * max(0.0, x)) for s, x in zip(SLACK, row)] for row in low]


def fit(samples: list, centroids: int = CENTROIDS) -> CentroidModel:
    """samples: (language, counts) in a fixed order."""
    languages = sorted({lang for lang, _ in samples})
    if not samples:
        return CentroidModel(np.ones(DIM, np.float32), np.zeros((0, DIM), np.float32), [], [], [])
    counts = np.stack([c for _, c in samples])
    df = (counts > 0).sum(axis=0)
    idf = (np.log((1 + len(counts)) / (1 + df)) + 1).astype(np.float32)
    model = CentroidModel(idf, None, None, None, languages)
    vecs = model.vectors(counts)
    rows, owner, radius = [], [], []
    for k, lang in enumerate(languages):
        mine = [i for i, (name, _) in enumerate(samples) if name == lang]
        x = vecs[mine]
        mean = x.mean(axis=0)
        seeds = [int((x @ mean).argmax())]
        while len(seeds) < min(centroids, len(x)):
            seeds.append(int((x @ x[seeds].T).max(axis=1).argmin()))
        c = x[seeds]
        for _ in range(20):
            near = (x @ c.T).argmax(axis=1)
            new = np.stack([x[near == j].mean(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
            new /= np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
            if np.allclose(new, c, atol=1e-6):
                break
            c = new
        rows.append(c)
        owner += [k] * len(c)
        radius += _radii(model, counts[mine], c)
    model.centroids, model.owner, model.radius = np.concatenate(rows).astype(np.float32), owner, radius
    return model


def train(docs: DataFrame, learnable, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = TRAIN_PER_LANGUAGE) -> CentroidModel:
    """Fit on rows where ``learnable`` (a column) holds and the language and
    text are not null."""
    rows = docs.where(learnable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
        F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string")).alias("h"))
    n = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if not n:
        return fit([])
    share = F.create_map(*[F.lit(x) for lang, k in n.items()
                           for x in (lang, int(min(1.0, per_language / k) * (1 << 30)))])
    picked = (rows.where(F.pmod("h", F.lit(1 << 30)) < share[F.col("lang")])
              .groupBy("lang", "h").agg(F.max("text").alias("text")))

    def vectorise(batches):
        for b in batches:
            lang, h, at, count = [], [], [], []
            for name, key, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                if has_letter(text):
                    c = ngram_counts(text)
                    nz = np.flatnonzero(c)
                    lang.append(name)
                    h.append(key)
                    at.append(nz.astype(np.int32))
                    count.append(c[nz])
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(h, pa.int64()), pa.array(at, pa.list_(pa.int32())),
                 pa.array(count, pa.list_(pa.float32()))], names=["lang", "h", "at", "count"])

    samples = []
    got = picked.mapInArrow(vectorise, "lang string, h bigint, at array<int>, count array<float>").toArrow()
    for lang, h, at, count in sorted(zip(*(got.column(i).to_pylist() for i in range(4)))):
        c = np.zeros(DIM, np.float32)
        c[at] = count
        samples.append((lang, c))
    return fit(samples)


def predict(docs: DataFrame, model: CentroidModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score, rejected."""
    src = id_and_text(docs, id_col, text_col)

    def run(batches):
        for b in batches:
            got = []
            for at in range(0, b.num_rows, 256):
                got += model.predict(b.column(1).slice(at, 256).to_pylist())
            lang, score, rejected = zip(*got) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(rejected, pa.bool_())], names=["doc_id", "lang_pred", "score", "rejected"])

    return src.mapInArrow(run, f"doc_id {id_type(src)}, lang_pred string, score double, rejected boolean")


def drop_rejected(docs: DataFrame, model: CentroidModel, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text the model rejects; all columns, the
    same rows otherwise (repeated rows each decided for themselves)."""
    cols = docs.columns
    at = cols.index(text_col)

    def run(batches):
        for b in batches:
            keep = []
            for i in range(0, b.num_rows, 256):
                keep += [not r for _, _, r in model.predict(b.column(at).slice(i, 256).to_pylist())]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
