"""Benchmark decontamination on a positional inverted index (operator 13).

``build_index`` writes the postings of every training token: documents are dealt
to shards of about ``SHARD`` words, and a shard has one row per term with its
positions, delta-coded.  Documents lie ``GAP`` positions apart, so no match runs
over the end of one; documents longer than a shard go on in the next one, with
``GAP`` words repeated.  Index rows are split by shard, never by term, so the
list of a very frequent word is cut into pieces of bounded size.

A search takes the benchmark's items in blocks of ``BLOCK`` words.  Term counts
of the whole corpus come from the index; windows with a term that occurs nowhere
are done.  The others begin with the list of their rarest term, its positions
shifted to the item's beginning, and intersect it with the shifted lists of their
other terms, rarest first; windows that share the rarest term share the lists.
Only the lists of terms in live windows are read, each shard's by one task.

``phrase_matches`` returns exact occurrences of windows, ``proximity_matches``
places where all words of a window stand within ``window + slack`` words in any
order.  Windows are ``window`` consecutive words of an item; an item of fewer
words, but not none, is one window.  Words are runs of 0-9, a-z and non-ASCII
characters after lower-casing A-Z.

Null and empty texts have no words; such items match nothing, such documents have
zeros.  Items of one id are one item; an item with a null id marks words but is
neither counted nor listed.  Repeated rows are documents of their own.  Very long
texts are cut into words piece by piece.  Empty tables: no documents give no rows,
no items give zeros.  Other columns, of whatever name, are left behind.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regmine.llm.common import bytes_of, id_and_text, id_type, write_shared

SHARD = 1 << 22              # positions of a shard (about)
GAP = 64                     # positions between documents, words repeated where a document is cut
BLOCK = 1 << 19              # item words searched for at a time (about)
ITEM = 1 << 16               # words of an item's part
PIECE = 1 << 20              # bytes of a text cut into words at a time
SEGMENTS = b""               # the term under which a shard lists its documents

# word bytes as they are, A-Z as a-z, all others as blanks
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))


def pieces(raw: bytes):
    """Words of a whole text, in lists of bounded length."""
    text, at = raw.translate(_TABLE), 0
    while at < len(text):
        end = len(text)
        if end - at > PIECE:
            end = text.rfind(b" ", at, at + PIECE)
            if end < 0:
                end = text.find(b" ", at + PIECE)
                end = len(text) if end < 0 else end
        words = text[at:end].split()
        if words:
            yield words
        at = end + 1


# ---- the index --------------------------------------------------------------

class _Numbers(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


class Shard:
    """Postings of some documents, kept as term numbers in order of position."""

    def __init__(self):
        self.numbers, self.terms, self.at, self.segments, self.size = _Numbers(), [], [], [], 0

    def begin(self, row: int, first: int) -> None:
        """The words that follow are those of document ``row`` from ``first`` on."""
        self.size += GAP
        self.segments.append((row, self.size, first))

    def extend(self, words: list) -> None:
        n = len(words)
        self.terms.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, n))
        self.at.append(np.arange(self.size, self.size + n, dtype=np.int32))
        self.size += n

    def columns(self):
        """(terms, counts, delta-coded postings as one Arrow array)."""
        terms, at = np.concatenate(self.terms), np.concatenate(self.at)
        order = np.argsort(terms, kind="stable")
        at = at[order]
        counts = np.bincount(terms, minlength=len(self.numbers))
        ends = np.concatenate([[0], np.cumsum(counts)])
        delta = np.diff(at, prepend=np.int32(0)).astype("<i4")
        delta[ends[:-1]] = at[ends[:-1]]
        names, counts = list(self.numbers), counts.tolist()
        listed = np.array(self.segments, dtype="<i8").tobytes()
        data = pa.Array.from_buffers(pa.binary(), len(names),
                                     [None, pa.py_buffer((ends * 4).astype("<i4")), pa.py_buffer(delta)])
        return [SEGMENTS, *names], [0, *counts], pa.concat_arrays([pa.array([listed], pa.binary()), data])


@dataclass
class PositionalIndex:
    """``table`` holds postings (shard, term, n, data) and, in rows without a
    shard, the documents (row, doc_id, n_words)."""
    table: DataFrame

    @property
    def postings(self) -> DataFrame:
        return self.table.where("shard IS NOT NULL").select("shard", "term", "n", "data")

    @property
    def documents(self) -> DataFrame:
        return self.table.where("shard IS NULL").select("row", "doc_id", "n_words")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> PositionalIndex:
    """Store the postings of all documents in the shared folder (one narrow pass)."""
    src = id_and_text(docs, id_col, text_col)
    most = SHARD

    def run(batches):
        from pyspark import TaskContext
        row = number = TaskContext.get().partitionId() << 33
        shard = Shard()
        names = ["shard", "term", "n", "data", "row", "doc_id", "n_words"]

        def stored(shard, number, kind):
            terms, counts, data = shard.columns()
            m = len(terms)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, number), pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.int64()),
                 data, pa.nulls(m, pa.int64()), pa.nulls(m, kind), pa.nulls(m, pa.int64())], names=names)

        kind = None
        for b in batches:
            kind = b.column(0).type
            rows, sizes = [], []
            for raw in bytes_of(b.column(1)):
                n, tail, begun = 0, [], False
                for words in pieces(raw):
                    if shard.size >= most:
                        yield stored(shard, number, kind)
                        shard, number, begun = Shard(), number + 1, False
                    if not begun:
                        shard.begin(row, n - len(tail))
                        if tail:
                            shard.extend(tail)
                        begun = True
                    shard.extend(words)
                    n += len(words)
                    tail = (tail + words)[-GAP:]
                rows.append(row)
                sizes.append(n)
                row += 1
            m = len(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()),
                 pa.array(rows, pa.int64()), b.column(0), pa.array(sizes, pa.int64())], names=names)
        if shard.size:
            yield stored(shard, number, kind)

    return PositionalIndex(write_shared(src.mapInArrow(
        run, f"shard bigint, term binary, n bigint, data binary, row bigint, doc_id {id_type(src)}, n_words bigint"),
        "positional-index"))


# ---- the benchmark, in blocks --------------------------------------------------

def _item_blocks(items: DataFrame, window: int, id_col: str, text_col: str):
    """(block number, [(item_id, words)]) of all items, one block on the driver
    at a time; items longer than ITEM words in parts that share window - 1 words."""
    src = items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    longest = max(ITEM, 2 * window)

    def run(batches):
        from pyspark import TaskContext
        part, total = TaskContext.get().partitionId(), 0

        def row(item, words):
            nonlocal total
            total += len(words)
            return {"part": part, "upto": total, "item_id": item, "words": words}

        schema = pa.schema([("part", pa.int32()), ("upto", pa.int64()), ("item_id", pa.string()),
                            ("words", pa.list_(pa.binary()))])
        for b in batches:
            for item, raw in zip(b.column(0).to_pylist(), bytes_of(b.column(1))):
                held, rows = [], []
                for words in pieces(raw):
                    held += words
                    while len(held) > longest:
                        rows.append(row(item, held[:longest]))
                        held = held[longest - window + 1:]
                if held:
                    rows.append(row(item, held))
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    parts = write_shared(src.mapInArrow(run, "part int, upto bigint, item_id string, words array<binary>"),
                         "benchmark-items")
    before, total = {}, 0
    for r in parts.groupBy("part").agg(F.max("upto").alias("n")).orderBy("part").collect():   # one row a partition
        before[r["part"]], total = total, total + r["n"]
    if not total:
        return
    first = F.create_map(*[F.lit(x) for p, n in before.items() for x in (p, n)])
    block = F.floor((F.col("upto") - F.size("words") + first[F.col("part")]) / BLOCK)
    parts = parts.withColumn("block", block)
    for k in range((total - 1) // BLOCK + 1):
        got = parts.where(F.col("block") == k).collect() if total > BLOCK else parts.collect()
        if got:
            yield [(r["item_id"], [bytes(w) for w in r["words"]]) for r in got]


def plan_windows(items: list, freq: dict, window: int) -> dict:
    """{rarest term: [(item number, its offset, first window, last window)]} of
    the windows whose words all occur.  The windows that share the place of
    their rarest word follow one another."""
    plan = defaultdict(list)
    for k, (_, words) in enumerate(items):
        f = np.array([freq.get(w, 0) for w in words])
        size = min(window, len(f))
        views = np.lib.stride_tricks.sliding_window_view(f, size)
        rarest = np.arange(len(views)) + views.argmin(axis=1)
        live = np.flatnonzero(views.min(axis=1) > 0)
        for group in np.split(live, np.flatnonzero(np.diff(rarest[live])) + 1) if len(live) else []:
            o = int(rarest[group[0]])
            plan[words[o]].append((k, o, int(group[0]), int(group[-1])))
    return dict(plan)


def _in(values: np.ndarray, sorted_list: np.ndarray) -> np.ndarray:
    at = np.searchsorted(sorted_list, values)
    return (at < len(sorted_list)) & (sorted_list[np.minimum(at, len(sorted_list) - 1)] == values)


def intersect(lists, words: list, size: int, freq: dict, anchor: tuple) -> np.ndarray:
    """Positions where the windows of ``anchor`` (offset of the rarest word,
    first and last window) occur, from offset-adjusted lists."""
    o, low, high = anchor
    base = lists(words[o]) - o
    alive = np.ones((len(base), high - low + 1), dtype=bool)
    for j in sorted((j for j in range(low, high + size) if j != o), key=lambda j: (freq[words[j]], j)):
        some = slice(max(low, j - size + 1) - low, min(high, j) - low + 1)
        post = lists(words[j])
        alive[~_in(base + j, post) if post is not None else slice(None), some] = False
        kept = alive.any(axis=1)
        if not kept.all():
            base, alive = base[kept], alive[kept]
            if not len(base):
                break
    at, which = np.nonzero(alive)
    return base[at] + low + which


def within(lists, words: list, span: int, freq: dict):
    """(start, end) intervals of at most ``span`` positions that hold every word,
    the narrowest around each position of the rarest word."""
    terms = sorted(set(words), key=lambda w: (freq[w], w))
    posts = [lists(w) for w in terms]
    if any(p is None for p in posts):
        return np.zeros((0, 2), dtype=np.int64)
    near = posts[0].astype(np.int64)
    for p in posts[1:]:
        at = np.searchsorted(p, near - span + 1)
        near = near[(at < len(p)) & (p[np.minimum(at, len(p) - 1)] < near + span)]
        if not len(near):
            break
    found = []
    for some in np.array_split(near, len(near) // 4096 + 1):
        start = some[:, None] - np.arange(span)                     # every beginning that still holds the position
        last = start.copy()
        for p in posts:
            at = np.searchsorted(p, start)
            last = np.maximum(last, np.where(at < len(p), p[np.minimum(at, len(p) - 1)], np.int64(1) << 40))
        size = last - start
        best = size.argmin(axis=1)
        pick = np.arange(len(some)), best
        ok = size[pick] < span
        found.append(np.stack([start[pick], last[pick] + 1], axis=1)[ok])
    return np.unique(np.concatenate(found), axis=0)


def _merged(item: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Overlapping and touching intervals of an item as one."""
    order = np.lexsort((end, start, item))
    item, start, end = item[order], start[order], end[order]
    reach = np.empty_like(end)
    for i in np.split(np.arange(len(item)), np.flatnonzero(np.diff(item)) + 1):
        reach[i] = np.maximum.accumulate(end[i])
    new = np.concatenate([[True], (np.diff(item) != 0) | (start[1:] > reach[:-1])])
    begin = np.flatnonzero(new)
    return item[begin], start[begin], np.append(reach[begin[1:] - 1], reach[-1])


MATCHES = "row bigint, item_id string, start bigint, end bigint"


def _search(index: PositionalIndex, items: list, window: int, span: int | None) -> DataFrame | None:
    """Matches of one block of items: exact windows, or with ``span`` windows
    whose words stand within so many words."""
    spark = index.table.sparkSession
    terms = sorted({w for _, words in items for w in words})
    # at most a block's words
    asked = F.broadcast(spark.createDataFrame([(w,) for w in terms], "term binary"))
    freq = {bytes(r["term"]): r["n"] for r in index.postings.join(asked, "term").groupBy("term")
            .agg(F.sum("n").alias("n")).collect()}
    plan = plan_windows(items, freq, window)
    if not plan:
        return None
    live = {SEGMENTS}
    for anchors in plan.values():
        for k, _, low, high in anchors:
            live.update(items[k][1][low:high + min(window, len(items[k][1]))])
    freq = {w: n for w, n in freq.items() if w in live}
    sent = spark.sparkContext.broadcast((items, plan, freq))
    wanted = F.broadcast(spark.createDataFrame([(w,) for w in sorted(live)], "term binary"))

    def matches(held: dict):
        items, plan, freq = sent.value
        segments = np.frombuffer(held.pop(SEGMENTS), dtype="<i8").reshape(-1, 3)
        lists: dict = {}

        def postings(word):
            if word in held:
                lists[word] = np.cumsum(np.frombuffer(held.pop(word), dtype="<i4"), dtype=np.int64)
            return lists.get(word)

        item, start, end = [], [], []
        for word, anchors in plan.items():
            if postings(word) is None:
                continue
            for k, o, low, high in anchors:
                words = items[k][1]
                size = min(window, len(words))
                if span is None:
                    got = intersect(postings, words, size, freq, (o, low, high))
                    got = np.stack([got, got + size], axis=1)
                else:
                    got = np.concatenate([within(postings, words[s:s + size], size + span, freq)
                                          for s in range(low, high + 1)])
                item.append(np.full(len(got), k))
                start.append(got[:, 0])
                end.append(got[:, 1])
        if not sum(map(len, item)):
            return None
        item, start, end = (np.concatenate(x) for x in (item, start, end))
        if span is None:
            item, start, end = _merged(item, start, end)
        at = np.searchsorted(segments[:, 1], start, side="right") - 1
        row, move = segments[at, 0], segments[at, 2] - segments[at, 1]
        return pa.RecordBatch.from_arrays(
            [pa.array(row), pa.array([items[k][0] for k in item.tolist()], pa.string()),
             pa.array(start + move), pa.array(end + move)], names=["row", "item_id", "start", "end"])

    def run(batches):
        number, held = None, {}
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                some = b.slice(i, 1024)
                for s, term, data in zip(*(some.column(j).to_pylist() for j in range(3))):
                    if s != number:
                        if len(held) > 1 and (out := matches(held)):
                            yield out
                        number, held = s, {}
                    held[term] = data
        if len(held) > 1 and (out := matches(held)):
            yield out

    shards = index.postings.join(wanted, "term").select("shard", "term", "data")
    return shards.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, MATCHES)


def _all_blocks(index, items, window, span, id_col, text_col) -> DataFrame:
    if window + (span or 0) > GAP:
        raise ValueError(f"a window and its slack may have {GAP} words at most")
    out = index.table.sparkSession.createDataFrame([], MATCHES)
    for block in _item_blocks(items, window, id_col, text_col):
        found = _search(index, block, window, span)
        if found is not None:
            out = out.unionByName(write_shared(found, "matches"))
    return out


def phrase_matches(index: PositionalIndex, items: DataFrame, window: int = 10, id_col: str = "item_id",
                   text_col: str = "text") -> DataFrame:
    """(row, item_id, start, end): runs of document words inside occurrences of
    the item's windows; ``row`` is the document's in ``index.documents``."""
    return _all_blocks(index, items, window, None, id_col, text_col)


def proximity_matches(index: PositionalIndex, items: DataFrame, window: int = 10, slack: int = 2,
                      id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(row, item_id, start, end): the narrowest runs of at most window + slack
    document words, around each place of a window's rarest word, that hold every
    word of the window (fewer for an item of fewer words)."""
    return _all_blocks(index, items, window, slack, id_col, text_col).distinct()


def contamination(index: PositionalIndex, matches: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated.  Only matches and document numbers are shuffled."""
    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max("end").over(before), F.lit(0))
    per_doc = (matches.withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest("start", reach)))
               .groupBy("row").agg(F.sum("new").alias("n_hit"), F.sort_array(F.collect_set("item_id")).alias("ids")))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return index.documents.join(per_doc, "row", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
