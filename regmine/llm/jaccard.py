"""N-gram Jaccard join with signature trees (operator 4).

A document is the set of its distinct five-word shingles (64-bit hashes).  Two
documents link when 100 * intersection >= 80 * union.  Sets of equal content are
one class; the work below is on classes.

Where two linked sets must meet: in some order of all shingles, two sets with a
Jaccard similarity of 0.8 share a shingle among the first n - ceil(0.8 n) + 1 of
each.  The order puts frequent shingles last (the most frequent ones of the
whole corpus, at most ``HOT_LIMIT``), then goes by hash; any order is exact, this
one keeps passages that many documents share from forming large groups.  Sets
that share such a shingle form a group, dealt by shingle.

Inside a group a signature tree is built over the sets in order of size: a leaf
holds a few sets, a node the OR of their token bitmaps and their range of sizes.
Traversing the tree against itself prunes node pairs whose largest possible
overlap is below what the smallest sets would need; leaves are compared set by
set on bitmaps, again by an upper bound.  Survivors are verified on full sets.

Two rounds keep groups of copies from forming all pairs.  The first deals the
first two shingles and the few with the smallest hashes (which similar sets share
most likely, while the first ones of a family of copies may be those of its edits)
and, in each group, keeps the most similar pairs that
connect it (a spanning forest); verified links make components.  The second
deals all prefix shingles, drops every set that has no set of another component
within its range of sizes in the group, and tests all remaining pairs of
different components: no link is lost.

Shingles that very many sets share (found by counts of hashed shingles) are dealt
by range of sizes in both rounds: linked sets lie in the same range or in
neighbouring ones.  Which of their sets have a partner follows from aggregates by
size, so no task holds such a group; what remains is split into blocks.

Components come from alternating star contractions, all in DataFrames.  Texts are
shingled anew where sets are needed instead of storing all sets.

Words are lower-cased A-Z; white space is space and \\t \\n \\v \\f \\r.  With fewer
than five words the whole sequence is the one shingle; null, empty and blank
texts have no shingle and link with nothing.  Rows with a null id share the
component of rows with the same set (null if there is none) and link nothing
themselves.  Repeated rows get equal results; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regmine.llm.common import bytes_of, id_and_text, id_type, sent_if_small, unused, write_shared

WORDS = 5
SHARE = (80, 100)            # 100 * intersection >= 80 * union
HOT_LIMIT = 500_000          # frequent shingles put last in the order (8 bytes each, broadcast)
LEAST = 6                    # shingles with the smallest hashes, of every set, by which the first round deals
HOT_COUNT = 8                # fewest early appearances that make a shingle frequent
PROBE = 20                   # 1/20 of a set's shingles are counted to find frequent ones
LEAF = 32                    # sets per leaf
FANOUT = 8                   # children per node
RUN = 2048                   # sets compared at a time where a group need only be connected
HUBS = 8                     # best connected sets of a run that also stand in the next one
BLOCK = 2048                 # larger groups are split into blocks; every pair of blocks is compared
SPLIT = 16_384               # groups above this many sets are dealt by range of sizes, and in parts
COMMON = 256                 # sets of a group (about) that all its parts of the first round have
BUCKETS = 1 << 16            # of hashed shingles, counted to find the large groups
HELD = 1 << 20               # rows of a group held to test it; longer ones pass untested
RANGE = math.log(SHARE[1] / SHARE[0])  # sizes of linked sets differ by at most this in logarithm
TEXT_BLOCK = 1 << 20         # bytes hashed at a time
BROADCAST_BYTES = 16 << 20   # ids are broadcast below this size, joined by a shuffle beyond

_RNG = np.random.default_rng(20240601)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_TURN = [np.uint64(int(x) | 1) for x in _RNG.integers(0, 1 << 63, WORDS, dtype=np.uint64)]
_EMPTY = np.zeros(0, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(buf: bytes):
    """(start of every word in ``buf``, its 64-bit hash)."""
    a = np.frombuffer(buf, dtype=np.uint8)
    space = (a == 32) | ((a >= 9) & (a <= 13))
    first = ~space
    first[1:] &= space[:-1]
    start = np.flatnonzero(first)
    if not len(start):
        return start, _EMPTY
    at = np.arange(len(a)) - start[np.maximum(np.cumsum(first) - 1, 0)]
    at[space] = 0
    power = np.cumprod(np.full(int(at.max()) + 1, _STEP, dtype=np.uint64))
    value = _BYTE[a] * power[at]
    value[space] = 0
    return start, _mix(np.add.reduceat(value, start))


def _from_words(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes of one document's word hashes."""
    n = len(words)
    if n >= WORDS:
        return np.unique(_shingles(words))
    if n == 0:
        return _EMPTY
    with np.errstate(over="ignore"):
        h = np.uint64(n)
        for w in words:
            h = h * _STEP + w
    return _mix(np.array([h], dtype=np.uint64))


def _shingles(words: np.ndarray) -> np.ndarray:
    n = len(words) - WORDS + 1
    s = words[:n] * _TURN[0]
    for j in range(1, WORDS):
        s = s + words[j:j + n] * _TURN[j]
    return _mix(s)


def _long_words(raw: bytes) -> np.ndarray:
    """Word hashes of a long text, block by block, cut at white space."""
    parts, at = [], 0
    while at < len(raw):
        end = at + TEXT_BLOCK
        while end < len(raw) and raw[end] not in b" \t\n\v\f\r":
            end += 1
        parts.append(_word_hashes(raw[at:end])[1])
        at = end
    return np.concatenate(parts) if parts else _EMPTY


def shingle_sets(raws):
    """Sorted distinct shingle hashes of each text (bytes), in order."""
    held, size = [], 0
    for raw in raws:
        raw = raw.lower()                            # bytes: A-Z only
        if len(raw) > TEXT_BLOCK:
            yield from _some_sets(held)
            held, size = [], 0
            yield _from_words(_long_words(raw))
            continue
        held.append(raw)
        size += len(raw)
        if size > TEXT_BLOCK // 2:
            yield from _some_sets(held)
            held, size = [], 0
    yield from _some_sets(held)


def _some_sets(raws):
    if not raws:
        return
    start, words = _word_hashes(b"\n".join(raws) + b"\n")
    edge = np.cumsum([0] + [len(r) + 1 for r in raws])
    cut = np.searchsorted(start, edge)
    every = _shingles(words) if len(words) >= WORDS else _EMPTY
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        yield np.unique(every[a:b - WORDS + 1]) if b - a >= WORDS else _from_words(words[a:b])


def set_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def prefix_length(n: int) -> int:
    """Shingles of a set of n among which a linked set must share one."""
    return n - -(-SHARE[0] * n // SHARE[1]) + 1


def needed(nx, ny):
    """Smallest intersection with which sets of these sizes link."""
    a, b = SHARE
    return -(-(a * (nx + ny)) // (a + b))


def bitmap(s: np.ndarray) -> np.ndarray:
    """Token bitmap, a power of two of bits: at least two per shingle, and eight
    for small sets (up to 2,048 bits), whose bound is then almost exact."""
    power = lambda n: 1 << (n - 1).bit_length()
    bits = max(64, power(2 * len(s)), min(2048, power(8 * len(s))))
    out = np.zeros(bits // 8, dtype=np.uint8)
    place = (s & np.uint64(bits - 1)).astype(np.int64)
    np.bitwise_or.at(out, place >> 3, (1 << (place & 7)).astype(np.uint8))
    return out.view("<u8")


def fold(words: np.ndarray, width: int) -> np.ndarray:
    """A bitmap (last axis) folded to ``width`` words by OR."""
    while words.shape[-1] > width:
        half = words.shape[-1] // 2
        words = words[..., :half] | words[..., half:]
    return words


class _Tree:
    """Node of a signature tree over sets sorted by size: positions lo..hi-1."""
    __slots__ = ("lo", "hi", "small", "large", "bits", "excess", "children")


def _leaf(lo, hi, sizes, maps):
    t = _Tree()
    t.lo, t.hi, t.small, t.large, t.children = lo, hi, int(sizes[lo]), int(sizes[hi - 1]), ()
    width = min(len(m) for m in maps[lo:hi])
    rows = np.stack([fold(m, width) for m in maps[lo:hi]])
    t.bits = np.bitwise_or.reduce(rows, axis=0)
    t.excess = int((sizes[lo:hi] - np.bitwise_count(rows).sum(axis=1)).max())
    return t


def _join(children):
    t = _Tree()
    t.lo, t.hi, t.children = children[0].lo, children[-1].hi, children
    t.small, t.large = children[0].small, children[-1].large
    width = min(len(c.bits) for c in children)
    t.bits = np.bitwise_or.reduce(np.stack([fold(c.bits, width) for c in children]), axis=0)
    # folding makes more tokens share a bit: bounded by the set's size
    t.excess = max(c.excess if len(c.bits) == width else c.large for c in children)
    return t


def signature_tree(sizes, maps):
    level = [_leaf(i, min(i + LEAF, len(maps)), sizes, maps) for i in range(0, len(maps), LEAF)]
    while len(level) > 1:
        level = [_join(level[i:i + FANOUT]) for i in range(0, len(level), FANOUT)]
    return level[0]


def _possible(a: _Tree, b: _Tree) -> bool:
    """Whether some set below a may link with some set below b (a before b)."""
    if SHARE[0] * b.small > SHARE[1] * a.large:       # sizes too far apart
        return False
    width = min(len(a.bits), len(b.bits))
    common = int(np.bitwise_count(fold(a.bits, width) & fold(b.bits, width)).sum())
    spare = min(a.excess if len(a.bits) == width else a.large, b.excess if len(b.bits) == width else b.large)
    most = min(common + spare, a.large, b.large)
    return most >= needed(max(a.small, -(-SHARE[0] * b.small // SHARE[1])), b.small)


def _compare(a: _Tree, b: _Tree, sizes, maps, comps, blocks):
    """(i, j, bound) of the sets of two leaves that may link; with ``blocks``
    only pairs of different blocks."""
    x, y = slice(a.lo, a.hi), slice(b.lo, b.hi)
    sx, sy = sizes[x][:, None], sizes[y][None, :]
    ok = (SHARE[1] * np.minimum(sx, sy) >= SHARE[0] * np.maximum(sx, sy)) & (comps[x][:, None] != comps[y][None, :])
    if blocks is not None:
        ok &= blocks[x][:, None] != blocks[y][None, :]
    if a is b:
        ok &= np.arange(a.lo, a.hi)[:, None] < np.arange(b.lo, b.hi)[None, :]
    i, j = np.nonzero(ok)
    i, j = i + a.lo, j + b.lo
    width = np.minimum([len(maps[p]) for p in i.tolist()], [len(maps[q]) for q in j.tolist()])
    out = [(i[:0], j[:0], np.zeros(0))]
    for w in np.unique(width):
        p, q = i[width == w], j[width == w]
        bp = np.stack([fold(maps[k], w) for k in range(a.lo, a.hi) if len(maps[k]) >= w])
        bq = np.stack([fold(maps[k], w) for k in range(b.lo, b.hi) if len(maps[k]) >= w])
        # sets are sorted by size, so those with narrower maps come first
        bp, bq = bp[p - (a.hi - len(bp))], bq[q - (b.hi - len(bq))]
        common = np.bitwise_count(bp & bq).sum(axis=1).astype(np.int64)
        most = np.minimum(sizes[p] - np.bitwise_count(bp).sum(axis=1) + common,
                          sizes[q] - np.bitwise_count(bq).sum(axis=1) + common)
        good = most >= needed(sizes[p], sizes[q])
        out.append((p[good], q[good], most[good] / (sizes[p] + sizes[q])[good]))
    return tuple(np.concatenate(x) for x in zip(*out))


def candidates(sizes: np.ndarray, maps: list, comps: np.ndarray, blocks=None):
    """Pairs (i, j, bound; three arrays) of a group, sorted by size, that may
    link and lie in different components: dual traversal of its signature
    tree."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    if len(maps) > 1:
        root = signature_tree(sizes, maps)
        stack = [(root, root)]
        while stack:
            a, b = stack.pop()
            if a is not b and not _possible(a, b):
                continue
            if not a.children and not b.children:
                found.append(_compare(a, b, sizes, maps, comps, blocks))
            elif a is b:
                c = a.children
                stack.extend((c[i], c[j]) for i in range(len(c)) for j in range(i, len(c)))
            elif not b.children or (a.children and a.hi - a.lo >= b.hi - b.lo):
                stack.extend((c, b) for c in a.children)
            else:
                stack.extend((a, c) for c in b.children)
    return tuple(np.concatenate(x) for x in zip(*found))


def _spanning(pairs, n: int):
    """The most similar of ``pairs`` that connect what they connect (a maximum
    spanning forest, grown set by set), and how often each set is used."""
    i, j, score = pairs
    weight = np.zeros((n, n), dtype=np.float32)
    weight[i, j] = weight[j, i] = score
    best, parent, left = np.zeros(n, dtype=np.float32), np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    edges, degree = [], np.zeros(n, dtype=np.int64)
    for _ in range(n):
        v = int(np.where(left, best, -1).argmax())
        if best[v] > 0:
            edges.append((int(parent[v]), v))
            degree[[v, parent[v]]] += 1
        left[v] = False
        nearer = weight[v] > best
        best[nearer] = weight[v][nearer]
        parent[nearer] = v
    return edges, degree


def most_size(n, pos):
    """Largest size of a set that links with a set of ``n`` if the shingle at
    ``pos`` of its order is the first that they share."""
    a, b = SHARE
    return ((a + b) * (n - pos) - a * n) // a


def _group_pairs(spanning: bool):
    """Candidate pairs of the groups (token, part, p, q) of partitions sorted by
    group and size; columns token, part, p, q, block, nid, n, comp, pos, bits.
    With ``spanning`` a group is only to be connected: long ones are worked off
    in runs of RUN sets, the best connected sets of a run stand in the next."""
    def run(batches):
        group, held = None, []

        def flush():
            """Pairs (two arrays of nid) of the sets held."""
            if len(held) < 2:
                return []
            block, nid, n, comp, pos, bits = zip(*held)
            comp = np.array(comp)
            if (comp == comp[0]).all():
                return []
            n, nid = np.array(n, dtype=np.int64), np.array(nid, dtype=np.int64)
            pairs = candidates(n, [np.frombuffer(b, dtype="<u8") for b in bits], comp,
                               np.array(block) if group[2] != group[3] else None)
            if spanning:
                chosen, degree = _spanning(pairs, len(held))
                held[:] = [held[k] for k in sorted(np.argsort(-degree, kind="stable")[:HUBS].tolist())]
                i, j = np.array(chosen, dtype=np.int64).reshape(-1, 2).T
            else:
                # pairs whose first common shingle comes earlier meet there too
                most = most_size(n, np.array(pos, dtype=np.int64))
                i, j, _ = pairs
                ok = (n[j] <= most[i]) & (n[i] <= most[j])
                i, j = i[ok], j[ok]
            return [(np.minimum(nid[i], nid[j]), np.maximum(nid[i], nid[j]))] if len(i) else []

        def batch(found):
            a, b = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            new = np.ones(len(a), dtype=bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            return pa.RecordBatch.from_arrays([pa.array(a[new], pa.int64()), pa.array(b[new], pa.int64())],
                                              names=["a", "b"])

        for b in batches:
            out, size = [], 0
            for *key, block, nid, n, comp, pos, bits in zip(*(b.column(i).to_pylist() for i in range(10))):
                if key != group or (spanning and len(held) == RUN):
                    got = flush()
                    out += got
                    size += sum(len(x) for x, _ in got)
                    if key != group:
                        group, held = key, []
                    held.sort(key=lambda r: r[2])
                held.append((block, nid, n, comp, pos, bits))
                if size > 100_000:
                    yield batch(out)
                    out, size = [], 0
            yield batch(out)
        yield batch(flush())

    return run


def _profile(batches):
    """Per document: set size, set key, early shingles."""
    for b in batches:
        n, key, probe = [], [], []
        for s in shingle_sets(bytes_of(b.column(1))):
            n.append(len(s))
            key.append(set_key(s) if len(s) else None)
            probe.append(s[:-(-len(s) // PROBE)].view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(probe, pa.list_(pa.int64()))],
            names=["doc_id", "n", "key", "probe"])


def _prefixes(hot):
    """Per document: set key, bitmap, prefix shingles in the corpus order."""
    def run(batches):
        last = np.frombuffer(hot.value, dtype=np.uint64)
        for b in batches:
            key, bits, least, prefix = [], [], [], []
            for s in shingle_sets(bytes_of(b.column(1))):
                key.append(set_key(s) if len(s) else None)
                least.append(s[:LEAST].view(np.int64) if len(s) else None)
                bits.append(bitmap(s).tobytes() if len(s) else None)
                if len(last) and len(s):
                    at = np.minimum(np.searchsorted(last, s), len(last) - 1)
                    common = last[at] == s
                    s = np.concatenate([s[~common], s[common]])
                prefix.append(s[:prefix_length(len(s))].view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(key, pa.binary()), pa.array(bits, pa.binary()),
                 pa.array(least, pa.list_(pa.int64())), pa.array(prefix, pa.list_(pa.int64()))],
                names=["doc_id", "key", "bits", "least", "prefix"])

    return run


def _sets(batches):
    for b in batches:
        sets = [s.tobytes() for s in shingle_sets(bytes_of(b.column(1)))]
        keys = [hashlib.blake2b(s, digest_size=16).digest() for s in sets]
        ok = pa.array([k == w for k, w in zip(keys, b.column(2).to_pylist())], pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())],
                                         names=["nid", "shingles"]).filter(ok)


def _verify(batches):
    """The pairs that link."""
    for b in batches:
        keep = []
        for x, y in zip(b.column(2), b.column(3)):
            s, t = (np.frombuffer(v.as_py(), dtype=np.uint64) for v in (x, y))
            if len(s) > len(t):
                s, t = t, s
            at = np.minimum(np.searchsorted(t, s), len(t) - 1)
            both = int((t[at] == s).sum())
            keep.append(SHARE[1] * both >= SHARE[0] * (len(s) + len(t) - both))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(
            pa.array(keep, pa.bool_()))


def _frequent(profile: DataFrame, classes: DataFrame):
    """Sorted hashes of the corpus's most frequent early shingles, at most
    HOT_LIMIT; counted once per class over all classes."""
    early = profile.join(classes.select(F.col("rid").alias("doc_id"), "key"), ["doc_id", "key"], "left_semi")
    counts = write_shared(early.select(F.explode("probe").alias("token")).groupBy("token")
                          .agg(F.count("*").alias("c")).where(F.col("c") >= HOT_COUNT), "jaccard-frequent")
    by_size = sorted(counts.groupBy(F.floor(F.log2("c")).alias("p")).agg(F.count("*").alias("n")).collect(),
                     key=lambda r: -r["p"])
    total, least = 0, None
    for r in by_size:
        total += r["n"]
        if total > HOT_LIMIT:
            break
        least = r["p"]
    if least is None:
        return np.zeros(0, dtype=np.uint64)
    rows = counts.where(F.col("c") >= 2 ** int(least)).select("token").toArrow()
    return np.sort(rows.column(0).to_numpy().astype(np.int64).view(np.uint64))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): smallest node of each component of at least two nodes, by
    alternating large-star and small-star contraction; every step is written."""
    now = write_shared(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                       .where("u <> v").distinct(), "components")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = write_shared(large, "components")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        now = write_shared(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                           .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "components")
        new = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if new == mark:
            break
        mark = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _links(src: DataFrame, classes: DataFrame, pairs: DataFrame, tag: str) -> DataFrame:
    """The pairs (a, b) of classes that link, verified on full sets."""
    pairs = write_shared(pairs.distinct(), f"jaccard-pairs-{tag}")
    used = write_shared(pairs.select(F.col("a").alias("nid")).unionByName(pairs.select(F.col("b").alias("nid")))
                        .distinct().join(classes, "nid").select("nid", "rid", "key"), f"jaccard-used-{tag}")
    if used.count() * 48 <= BROADCAST_BYTES:
        used = F.broadcast(used)
    texts = src.join(used, src["doc_id"] == used["rid"]).select("nid", "text", "key")
    sets = write_shared(texts.mapInArrow(_sets, "nid bigint, shingles binary"), f"jaccard-sets-{tag}")
    left = sets.select(F.col("nid").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("nid").alias("b"), F.col("shingles").alias("y"))
    met = pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y")
    return write_shared(met.mapInArrow(_verify, "a bigint, b bigint").distinct(), f"jaccard-links-{tag}")


def _partnered(cols):
    """Which rows (token, nid, n, pos, comp; sorted by token and n) have a row of
    their token, of another component and of a size that they may link with."""
    token, _, n, pos, comp = cols
    if len(token) < 2:
        return np.zeros(len(token), dtype=bool)
    new = np.concatenate([[False], token[1:] != token[:-1]])
    group = np.cumsum(new) << 32
    turns = np.cumsum(new | np.concatenate([[False], comp[1:] != comp[:-1]]))
    place = group + n
    low = np.searchsorted(place, group - (-SHARE[0] * n // SHARE[1]))
    high = np.searchsorted(place, group + np.maximum(most_size(n, pos), 0), side="right")
    at, end = np.minimum(low, len(n) - 1), np.maximum(high - 1, 0)
    return (high > low) & ((turns[end] > turns[at]) | (comp[at] != comp))


def _test_groups(batches):
    """The partnered rows of partitions sorted by token, n and nid."""
    held, size, name, untested = [], 0, None, None

    def out(parts, test):
        cols = [np.concatenate(x) for x in zip(*parts)]
        if test:
            keep = _partnered(cols)
            cols = [c[keep] for c in cols]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                          names=["token", "nid", "n", "pos", "comp"])

    for b in batches:
        cols = [b.column(i).to_numpy() for i in range(5)]
        if not b.num_rows:
            continue
        if untested is not None:                     # the rest of a group that was too long to hold
            more = int(np.searchsorted(cols[0], untested, side="right"))
            if more:
                yield out([[c[:more] for c in cols]], False)
                cols = [c[more:] for c in cols]
                if not len(cols[0]):
                    continue
            untested = None
        last = int(np.searchsorted(cols[0], cols[0][-1]))
        if held and name != cols[0][-1] or last:
            yield out([*held, [c[:last] for c in cols]], True)
            held, size = [], 0
        held.append([c[last:] for c in cols])
        size, name = size + len(cols[0]) - last, cols[0][-1]
        if size > HELD:
            yield out(held, False)
            held, size, untested = [], 0, name
    if held:
        yield out(held, True)


def _large(tokens: DataFrame):
    """The buckets (column bucket, at most BUCKETS / 4 rows) of shingles that may
    stand for large groups; None if there is none.  Beyond SPLIT rows a bucket is
    large if it has four times the mean, so their number is bounded."""
    counts = write_shared(tokens.groupBy(F.pmod("token", F.lit(BUCKETS)).alias("bucket"))
                          .agg(F.count("*").alias("c")), "jaccard-buckets")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    large = counts.where(F.col("c") > max(SPLIT, 4 * total // BUCKETS)).select("bucket")
    return None if large.isEmpty() else large


def _crossing(rows: DataFrame, large: DataFrame | None) -> DataFrame:
    """The rows (token, nid, n, pos, comp) that may have a partner in another
    component, with ``part``: 0, or the range of sizes from 1 in large groups."""
    kind = "token bigint, nid bigint, n bigint, pos bigint, comp bigint"
    small = rows
    if large is not None:
        rows = rows.withColumn("bucket", F.pmod("token", F.lit(BUCKETS)))
        small = rows.join(F.broadcast(large), "bucket", "left_anti").drop("bucket")
    tested = (small.select("token", "nid", "n", "pos", "comp").repartition("token")
              .sortWithinPartitions("token", "n", "nid").mapInArrow(_test_groups, kind))
    tested = tested.withColumn("part", F.lit(0))
    if large is None:
        return tested
    big = rows.join(F.broadcast(large), "bucket", "left_semi").drop("bucket")
    # components that meet within reach of each size, in millionths of a logarithm
    reach = math.ceil(RANGE * 1e6) + 2
    near = Window.partitionBy("token").orderBy("at").rangeBetween(-reach, reach)
    met = (big.groupBy("token", "n").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
           .withColumn("at", F.floor(F.log("n") * 1e6).cast("bigint"))
           .select("token", "n", F.min("lo").over(near).alias("lo"), F.max("hi").over(near).alias("hi"))
           .where("lo < hi").select("token", "n"))
    met = sent_if_small(write_shared(met, "jaccard-met"), 32)
    return tested.unionByName(big.join(met, ["token", "n"], "left_semi").withColumn(
        "part", F.floor(F.log("n") / RANGE + 1e-9).cast("int") + 1))


def _connecting(rows: DataFrame) -> DataFrame:
    """Groups of the first round: parts of at most about SPLIT rows; some common
    rows stand in every part of a group, so parts connect."""
    counts = rows.groupBy("token", "part").agg(F.count("*").alias("c"))
    own = F.pmod(F.xxhash64("nid"), F.col("k")).cast("int")
    common = F.pmod(F.xxhash64("nid", F.lit(1)), F.greatest(F.lit(1), F.floor(F.col("c") / COMMON))) == 0
    return (rows.join(counts, ["token", "part"]).withColumn("k", F.ceil(F.col("c") / SPLIT).cast("int"))
            .withColumn("p", F.explode(F.when(common, F.sequence(F.lit(0), F.col("k") - 1)).otherwise(F.array(own))))
            .select("token", "part", "p", F.col("p").alias("q"), F.lit(0).alias("block"), "nid", "n", "comp", "pos"))


def _all_pairs(rows: DataFrame) -> DataFrame:
    """Groups of the second round: pairs of blocks.  Ranges of sizes also have the
    rows of the range below as guests, which do not meet each other."""
    rows = rows.select("token", "nid", "n", "comp", "pos", F.explode(
        F.when(F.col("part") == 0, F.array(F.struct(F.lit(0).alias("part"), F.lit(False).alias("guest"))))
        .otherwise(F.array(F.struct(F.col("part").alias("part"), F.lit(False).alias("guest")),
                           F.struct((F.col("part") + 1).alias("part"), F.lit(True).alias("guest"))))).alias("g"))
    rows = rows.select("token", "nid", "n", "comp", "pos", "g.part", "g.guest")
    blocks = lambda which: F.ceil(F.count(F.when(which, 1)) / BLOCK).cast("int")
    counts = rows.groupBy("token", "part").agg(blocks(~F.col("guest")).alias("own"), blocks(F.col("guest")).alias("more"))
    at = F.xxhash64("nid")
    block = F.when(F.col("guest"), F.col("own") + F.pmod(at, F.col("more"))).otherwise(F.pmod(at, F.col("own")))
    last = F.when(F.col("guest"), F.col("own") - 1).otherwise(F.col("own") + F.col("more") - 1)
    return (rows.join(counts.where("own > 0"), ["token", "part"]).withColumn("block", block.cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), last)))
            .select("token", "part", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"),
                    "block", "nid", "n", "comp", "pos"))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id
    reachable by links, its own included)."""
    src = id_and_text(docs, id_col, text_col)
    kind = id_type(src)
    profile = write_shared(src.mapInArrow(_profile, f"doc_id {kind}, n bigint, key binary, probe array<bigint>"),
                           "jaccard-profile")
    classes = write_shared(profile.where("key IS NOT NULL AND doc_id IS NOT NULL").groupBy("key")
                           .agg(F.min("doc_id").alias("rid"), F.max("n").alias("n"))
                           .withColumn("nid", F.monotonically_increasing_id()), "jaccard-classes")
    hot = src.sparkSession.sparkContext.broadcast(_frequent(profile, classes).tobytes())
    found = src.mapInArrow(_prefixes(hot), f"doc_id {kind}, key binary, bits binary, least array<bigint>, "
                           "prefix array<bigint>")
    reps = write_shared(found.join(classes.withColumnRenamed("rid", "doc_id"), ["doc_id", "key"])
                        .dropDuplicates(["doc_id", "key"]).select("nid", "n", "bits", "least", "prefix"), "jaccard-prefixes")

    def pairs(rows, large, spanning):
        """Pairs of the groups of rows (token, nid, n, pos, comp)."""
        rows = write_shared(_crossing(rows, large), "jaccard-crossing")
        rows = _connecting(rows) if spanning else _all_pairs(rows)
        group = ["token", "part", "p", "q"]
        full = rows.join(reps.select("nid", "bits"), "nid").select(*group, "block", "nid", "n", "comp", "pos", "bits")
        return (full.repartition(*group).sortWithinPartitions(*group, "n", "nid")
                .mapInArrow(_group_pairs(spanning), "a bigint, b bigint"))

    first = reps.select(F.explode(F.array_union("least", F.slice("prefix", 1, 2))).alias("token"), "nid", "n",
                        F.lit(0).alias("pos"), F.col("nid").alias("comp"))
    links = _links(src, classes, pairs(first, _large(first), True), "first")
    comp = write_shared(components(links), "jaccard-first-components")
    joined = reps.select("nid", "n", "prefix").join(sent_if_small(comp, 16), F.col("nid") == F.col("node"), "left")
    rows = joined.select(F.posexplode("prefix").alias("pos", "token"), "nid", "n",
                         F.coalesce("root", "nid").alias("comp"))
    large = _large(reps.select(F.explode("prefix").alias("token")))
    rest = _links(src, classes, pairs(rows, large, False), "rest")
    # the components so far, joined by the new links
    every = comp.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(rest)
    final = write_shared(components(every), "jaccard-components")
    named = classes.join(final, F.col("nid") == F.col("node"), "left").select(
        "key", "rid", F.coalesce("root", "nid").alias("root"))
    smallest = named.groupBy("root").agg(F.min("rid").alias("component"))
    by_key = named.join(smallest, "root").select("key", "component")
    return profile.select("doc_id", F.col("n").alias("n_shingles"), "key").join(by_key, "key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest
    id (null ids last, then by text hash); rows without shingles stay.  All
    columns.  A document is an id and a text: an id with two texts is two of
    them, null ids link as others do.  Rows equal in both stay together (exact
    copies are not this function's)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # in this order the smallest document of a component has its smallest id
    document = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.md5(text).alias("text"))
    found = near_copies(docs.select(document.alias("doc_id"), text.alias("text")))
    mark, gone_id, gone_text = unused(docs, "_text_hash", "_gone_id", "_gone_text")
    gone = write_shared(found.where(F.col("component_id") != F.col("doc_id"))
                        .select(F.col("doc_id.id").alias(gone_id), F.col("doc_id.text").alias(gone_text))
                        .distinct(), "jaccard-gone")
    if gone.count() * 80 <= BROADCAST_BYTES:          # else the join shuffles the texts
        gone = F.broadcast(gone)
    marked = docs.withColumn(mark, F.md5(text))
    same = marked[id_col].eqNullSafe(gone[gone_id]) & (marked[mark] == gone[gone_text])
    return marked.join(gone, same, "left_anti").select(*docs.columns)
