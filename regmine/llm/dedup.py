"""Exact duplicates by Patricia-trie owners (operator 6).

Each input partition first folds its own equal texts together (a bounded
map-side combine), so a text that is a third of all rows reaches the shuffle
once per partition.  Folded texts are then dealt by (byte length, content hash);
every task inserts the full byte strings into a compressed radix trie whose
terminal nodes keep the owner and the size of the group.  When a trie holds more
bytes than its limit, its largest subtree is spilled to a file and worked off
afterwards.  Owners go back to the rows by the fold they came from, so no join
key is hotter than one input partition.

Texts are equal when identical after lower-casing A-Z only; null counts as
empty.  The row with the largest (or smallest) id stays; null ids lose to all
others; among rows with the same id the first by (partition, position) stays,
so exactly one row of a group is kept.  Very long texts are compared whole; one
fills a fold, and a trie's label, of its own.  Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regmine.llm.common import bytes_of, id_and_text, id_type, sent_if_small, unused, write_shared

FOLD_BYTES = 32 << 20        # text held by the map-side combine before it flushes
GONE_BYTES = 120             # of an id and a hash in hexadecimal
TRIE_BYTES = 64 << 20        # label bytes a trie holds before it spills a subtree


class Node:
    __slots__ = ("label", "children", "value", "spill")

    def __init__(self, label: bytes):
        self.label, self.children, self.value, self.spill = label, {}, None, None


class PatriciaTrie:
    """Compressed radix trie over byte strings; ``merge(old, new)`` combines the
    values of equal strings.  ``items()`` empties the trie."""

    def __init__(self, merge, limit: int = TRIE_BYTES):
        self.merge, self.limit, self.bytes = merge, limit, 0
        self.root = Node(b"")

    def insert(self, key: bytes, value) -> None:
        node, pos, n = self.root, 0, len(key)
        while True:
            if node.spill is not None:
                pickle.dump((key[pos:], value), node.spill)
                return
            if pos == n:
                node.value = value if node.value is None else self.merge(node.value, value)
                return
            child = node.children.get(key[pos])
            if child is None:
                leaf = Node(key[pos:])
                leaf.value = value
                node.children[key[pos]] = leaf
                self.bytes += n - pos + 200
                break
            label = child.label
            if key.startswith(label, pos):
                node, pos = child, pos + len(label)
                continue
            same = _common(label, key, pos)
            upper = Node(label[:same])
            child.label = label[same:]
            upper.children[child.label[0]] = child
            node.children[key[pos]] = upper
            self.bytes += 200
            node, pos = upper, pos + same
        if self.bytes > self.limit:
            self._spill()

    def _spill(self) -> None:
        """Move the largest subtree below the first branching node to a file."""
        top = self.root
        while True:
            inner = [c for c in top.children.values() if c.spill is None]
            if len(inner) == 1 and inner[0].children:
                top = inner[0]
                continue
            break
        if not inner:
            return
        victim = max(inner, key=_weight)
        spill = tempfile.TemporaryFile()
        for key, value in _walk(victim):
            if isinstance(value, tuple) and value and value[0] is _SPILLED:
                for rest, v in _read(value[1]):
                    pickle.dump((key + rest, v), spill)
            else:
                pickle.dump((key, value), spill)
        self.bytes -= _weight(victim) - len(victim.label)
        victim.children, victim.value, victim.spill = {}, None, spill

    def items(self):
        """Values of all strings; spilled subtrees are rebuilt one by one."""
        files = []
        for _, value in _walk(self.root):
            if isinstance(value, tuple) and value and value[0] is _SPILLED:
                files.append(value[1])
            else:
                yield value
        self.root, self.bytes = Node(b""), 0
        for f in files:
            sub = PatriciaTrie(self.merge, self.limit)
            for rest, value in _read(f):
                sub.insert(rest, value)
            f.close()
            yield from sub.items()


_SPILLED = object()


def _common(label: bytes, key: bytes, pos: int) -> int:
    """Length of the common prefix of label and key[pos:], by halving."""
    lo, hi = 0, min(len(label), len(key) - pos)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if label[lo:mid] == key[pos + lo:pos + mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _walk(node: Node):
    """(bytes below ``node``, value) of its terminals; a spilled subtree is
    given as (_SPILLED, file)."""
    stack = [(node, b"")]
    while stack:
        cur, path = stack.pop()
        if cur.spill is not None:
            yield path, (_SPILLED, cur.spill)
        if cur.value is not None:
            yield path, cur.value
        for c in cur.children.values():
            stack.append((c, path + c.label))


def _weight(node: Node) -> int:
    total, stack = 0, [node]
    while stack:
        cur = stack.pop()
        total += len(cur.label) + 200
        stack.extend(cur.children.values())
    return total


def _read(f):
    f.seek(0)
    while True:
        try:
            yield pickle.load(f)
        except EOFError:
            return


FOLD_SCHEMA = ("doc_id {id}, part bigint, row bigint, fold bigint, text_sha256 string, "
               "text binary, n bigint, owner {id}, owner_row bigint")


def _better(a, b, largest: bool):
    """The (id, part, row) that stays: larger id (nulls lose), then first row."""
    if a[0] != b[0]:
        if a[0] is None or b[0] is None:
            return b if a[0] is None else a
        return a if (a[0] > b[0]) == largest else b
    return a if a[1:] <= b[1:] else b


def _fold(arrow_id, largest):
    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        names = ["doc_id", "part", "row", "fold", "text_sha256", "text", "n", "owner", "owner_row"]
        types = [arrow_id, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int64(), arrow_id,
                 pa.int64()]

        def batch(rows):
            cols = list(zip(*rows)) if rows else [[] for _ in types]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        def flush():
            rows, held = [], 0
            for text, (fold, n, best, _) in folds.items():
                rows.append((None, part, None, fold, None, text, n, best[0], best[2]))
                held += len(text)
                if held > (4 << 20):
                    yield batch(rows)
                    rows, held = [], 0
            yield batch(rows)
            folds.clear()

        folds, held, row, next_fold = {}, 0, 0, 0
        for b in batches:
            out = []
            for doc_id, raw in zip(b.column(0).to_pylist(), bytes_of(b.column(1))):
                text = raw.lower()                       # bytes: A-Z only
                me = (doc_id, part, row)
                got = folds.get(text)
                if got is None:
                    sha = hashlib.sha256(text).hexdigest()
                    folds[text] = got = [next_fold, 1, me, sha]
                    next_fold += 1
                    held += len(text)
                else:
                    got[1] += 1
                    got[2] = _better(got[2], me, largest)
                out.append((doc_id, part, row, got[0], got[3], None, None, None, None))
                row += 1
                if held > FOLD_BYTES:
                    yield batch(out)
                    out = []
                    yield from flush()
                    held = 0
            yield batch(out)
        yield from flush()

    return run


def _owners(arrow_id, largest):
    def merge(a, b):
        a[2].extend(b[2])                            # in place: a text of many folds costs as many steps
        return (a[0] + b[0], _better(a[1], b[1], largest), a[2])

    def run(batches):
        trie = PatriciaTrie(merge)
        for b in batches:
            part, fold, n, owner, row = (b.column(i).to_pylist() for i in (1, 2, 3, 4, 5))
            for i in range(len(part)):
                text = b.column(0)[i].as_py()
                trie.insert(text, (n[i], (owner[i], part[i], row[i]), [(part[i], fold[i])]))
        out = []
        for n, best, folds in trie.items():
            out.extend((p, f, best[0], best[1], best[2], n) for p, f in folds)
            if len(out) > 20_000:
                yield batch(out)
                out = []
        yield batch(out)

    def batch(rows):
        types = [pa.int64(), pa.int64(), arrow_id, pa.int64(), pa.int64(), pa.int64()]
        cols = list(zip(*rows)) if rows else [[] for _ in types]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                          names=["part", "fold", "keep_id", "keep_part", "keep_row", "group_size"])

    return run


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     keep: str = "largest") -> DataFrame:
    """One row per input row, dropped ones too: doc_id, keep_id, group_size,
    kept, text_sha256 (of the lower-cased text), part and row (where the row
    stood in the input as it was read)."""
    from pyspark.sql.pandas.types import to_arrow_type
    src = id_and_text(docs, id_col, text_col)
    kind, arrow_id = id_type(src), to_arrow_type(src.schema["doc_id"].dataType)
    largest = keep == "largest"
    folded = write_shared(src.mapInArrow(_fold(arrow_id, largest), FOLD_SCHEMA.format(id=kind)), "dedup-folds")
    texts = (folded.where(F.col("row").isNull())
             .select("text", "part", "fold", "n", "owner", "owner_row",
                     F.octet_length("text").alias("len"), F.xxhash64("text").alias("h"))
             .repartition("len", "h").select("text", "part", "fold", "n", "owner", "owner_row"))
    owners = texts.mapInArrow(_owners(arrow_id, largest),
                              f"part bigint, fold bigint, keep_id {kind}, keep_part bigint, keep_row bigint, "
                              "group_size bigint")
    members = folded.where(F.col("row").isNotNull()).select("doc_id", "part", "row", "fold", "text_sha256")
    return members.join(owners, ["part", "fold"]).select(
        "doc_id", "keep_id", "group_size",
        ((F.col("part") == F.col("keep_part")) & (F.col("row") == F.col("keep_row"))).alias("kept"),
        "text_sha256", "part", "row")


def _lower_hash(text_col: str):
    """The text_sha256 of ``exact_duplicates`` as a column."""
    upper = "".join(map(chr, range(65, 91)))
    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), upper, upper.lower())
    return F.sha2(text, 256)


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    keep: str = "largest") -> DataFrame:
    """One row of each group of equal texts, the one ``exact_duplicates`` keeps
    by id; all columns.  Where that id (or null) stands on several rows of a
    group, the first of them by its columns as JSON text stays, so the choice does
    not depend on how the rows are read.  Columns of any name and type; the texts
    are only shuffled if the dropped rows' keys exceed ``BROADCAST_BYTES``."""
    res = exact_duplicates(docs, id_col, text_col, keep)
    mark, rank, gone_id, gone_text, again = unused(docs, "_text_hash", "_rank", "_gone_id", "_gone_text", "_again")
    # (id, hash) of the rows to drop; the texts stay where they are while these are few
    gone = write_shared(res.where(~F.col("kept")).select(
        F.col("doc_id").alias(gone_id), F.col("text_sha256").alias(gone_text),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias(again)).distinct(), "dedup-gone")
    marked = docs.withColumn(mark, _lower_hash(text_col))

    def same(table):
        return marked[id_col].eqNullSafe(table[gone_id]) & (marked[mark] == table[gone_text])

    left = marked.join(sent_if_small(gone, GONE_BYTES), same(gone), "left_anti").select(*docs.columns)
    repeated = write_shared(gone.where(again), "dedup-again")
    if repeated.isEmpty():
        return left
    # of rows that share id and text, the first by all their columns as text
    first = Window.partitionBy(id_col, mark).orderBy(F.to_json(F.struct(*docs.columns)))
    once = (marked.join(sent_if_small(repeated, GONE_BYTES), same(repeated), "left_semi")
            .withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1))
    return left.unionByName(once.select(*docs.columns))
