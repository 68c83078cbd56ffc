"""Best-two-fit packing of token sequences (operator 5).

Lengths are at most ``capacity``, so the whole corpus is described by a table
of counts with at most ``capacity`` rows, whatever its size.  The plan is made
on that table: a bin is filled greedily with the longest length that fits; then
its smallest document is replaced by the two unpacked documents that fit the
gap, widened by it, most tightly.  A bin's pattern is used as often as the
counts allow, which is what filling bin after bin would do.  The plan (a few
thousand slot ranges) is all the driver sees.  Pieces find their place by their
rank among pieces of the same length: rank inside their input partition plus
the partition's offset, so a length held by a third of all rows is never sorted
or gathered in one task.

Null and empty texts have one token (the end mark); documents longer than
``capacity`` are cut so that only the first piece may be shorter; repeated rows
are packed one by one; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regmine.llm import bpe
from regmine.llm.common import id_and_text, id_type, texts_of, write_shared


def plan_bins(counts: dict, capacity: int):
    """Slot ranges [(length, first rank, end rank, first bin, offset, per bin)]
    for ``counts`` (length -> number of pieces): the pieces of one length with
    ranks in the range go to consecutive bins, ``per bin`` to each, one after
    the other from ``offset``.  Returns (ranges, number of bins)."""
    have = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        have[length] = n
    taken = np.zeros(capacity + 1, dtype=np.int64)      # ranks handed out
    slots, bins = [], 0
    while True:
        open_lengths = np.flatnonzero(have)
        if not len(open_lengths):
            return slots, bins
        used, gap = {}, capacity
        while gap:
            free = open_lengths[: np.searchsorted(open_lengths, gap, side="right")]
            free = [x for x in free[::-1][: len(used) + 1] if have[x] > used.get(int(x), 0)]
            if not free:
                free = [x for x in open_lengths[::-1] if x <= gap and have[x] > used.get(int(x), 0)]
            if not free:
                break
            x = int(free[0])
            k = min(int(have[x]) - used.get(x, 0), gap // x)
            used[x] = used.get(x, 0) + k
            gap -= k * x
        while gap:
            small = min(used)
            pair = _two_that_fit(have, used, small, gap + small)
            if pair is None:
                break
            used[small] -= 1
            if not used[small]:
                del used[small]
            for x in pair:
                used[x] = used.get(x, 0) + 1
            gap = gap + small - sum(pair)
        times = min(int(have[x]) // k for x, k in used.items())
        at = 0
        for x, k in sorted(used.items(), reverse=True):
            slots.append((x, int(taken[x]), int(taken[x]) + k * times, bins, at, k))
            taken[x] += k * times
            have[x] -= k * times
            at += k * x
        bins += times


def _two_that_fit(have, used, small: int, room: int):
    """The two unpacked lengths with the largest sum in (small, room]; the
    larger one as large as possible on ties.  None if no pair beats ``small``."""
    left = have[: room + 1].copy()
    for x, k in used.items():
        if x <= room:
            left[x] -= k
    xs = np.flatnonzero(left > 0)
    if not len(xs):
        return None
    # best partner of every x: the largest y <= min(x, room - x); x with itself
    # needs two of them
    limit = np.minimum(xs, room - xs)
    at = np.searchsorted(xs, limit, side="right") - 1
    own = (at >= 0) & (xs[np.maximum(at, 0)] == xs) & (left[xs] < 2)
    at = at - own
    ok = at >= 0
    if not ok.any():
        return None
    x, y = xs[ok], xs[at[ok]]
    total = x + y
    best = int(total.max())
    if best <= small:
        return None
    i = np.flatnonzero(total == best)[-1]
    return int(x[i]), int(y[i])


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int,
                 id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids: doc_id, piece, start, length,
    ids_crc32, part and rank (among the pieces of this length in this input
    partition), and the ids on request (little-endian uint32 bytes)."""
    src = id_and_text(docs, id_col, text_col)
    end = np.array([end_id], dtype=bpe.INT32).tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"] + ["ids"] * with_ids

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        encode = bpe.library_encoder(tokenizer_path)
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            which, piece, start, length, crc, rank, kept = [], [], [], [], [], [], []
            for i, text in enumerate(texts_of(batch.column(1))):
                ids = encode(text).astype(bpe.INT32).tobytes() + end
                n = len(ids) // 4
                first = n % capacity or capacity
                cuts = [0, *range(first, n + 1, capacity)]
                for j in range(len(cuts) - 1):
                    a, b = cuts[j], cuts[j + 1]
                    raw = ids[4 * a:4 * b]
                    which.append(i)
                    piece.append(j)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(raw))
                    rank.append(int(seen[b - a]))
                    seen[b - a] += 1
                    if with_ids:
                        kept.append(raw)
            cols = [batch.column(0).take(pa.array(which, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                    pa.array(np.full(len(which), part), pa.int64()), pa.array(rank, pa.int64())]
            if with_ids:
                cols.append(pa.array(kept, pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return src.mapInArrow(run, f"doc_id {id_type(src)}, piece int, start bigint, length bigint, ids_crc32 bigint, "
                               "part bigint, rank bigint" + ", ids binary" * with_ids)


def pack_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """Give every piece (columns length, part, rank; written, not recomputed) a
    sequence_id and an offset; other columns stay."""
    by = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    by = write_shared(by, "pack-counts")
    counts = {r["length"]: r["n"] for r in by.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    slots, _ = plan_bins(counts, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = by.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("base")).drop("base")
    table = np.array(sorted(slots), dtype=np.int64).reshape(-1, 6)
    # one sorted key per (length, first rank); ranks stay below 2**50
    keys = (table[:, 0].astype(object) * (1 << 50) + table[:, 1]).astype(np.int64)
    names = [c for c in pieces.columns if c not in ("part", "rank")]
    at = {c: i for i, c in enumerate(ranked.columns)}

    def run(batches):
        for b in batches:
            length = b.column(at["length"]).to_numpy()
            rank = b.column(at["rank"]).to_numpy()
            i = np.searchsorted(keys, length * (1 << 50) + rank, side="right") - 1
            within = rank - table[i, 1]
            per = table[i, 5]
            yield pa.RecordBatch.from_arrays(
                [b.column(at[c]) for c in names]
                + [pa.array(table[i, 3] + within // per, pa.int64()),
                   pa.array(table[i, 4] + within % per * length, pa.int64())],
                names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in names)
    return ranked.mapInArrow(run, schema + ", sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2,
                   id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack whole documents: doc_id, piece, start, length,
    ids_crc32, (ids,) sequence_id, offset."""
    pieces = write_shared(token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, with_ids),
                          "pack-pieces")
    return pack_pieces(pieces, capacity)
