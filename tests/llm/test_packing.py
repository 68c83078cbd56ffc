"""Plan and placement of best-two-fit packing."""
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

from regmine.llm import packing
from regmine.llm.common import tokenizer_path
from regmine.llm.queries import op5_best_fit_packing


def lay_out(counts, capacity):
    slots, bins = packing.plan_bins(counts, capacity)
    fill, ranks = defaultdict(list), defaultdict(list)
    for length, lo, hi, first, at, per in slots:
        for r in range(lo, hi):
            fill[first + (r - lo) // per].append((at + (r - lo) % per * length, length))
            ranks[length].append(r)
    return fill, ranks, bins


def check(counts, capacity):
    fill, ranks, bins = lay_out(counts, capacity)
    assert len(fill) == bins
    for places in fill.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    for length, n in counts.items():
        assert sorted(ranks[length]) == list(range(n))
    return bins


def test_plan_places_everything_once():
    r = random.Random(3)
    for _ in range(200):
        cap = r.choice([5, 10, 37, 100])
        counts = dict(Counter(r.randint(1, cap) for _ in range(r.randint(0, 300))))
        bins = check(counts, cap)
        total = sum(k * v for k, v in counts.items())
        assert bins >= -(-total // cap)
        assert bins <= 1.25 * total / cap + 2


def test_two_replace_the_smallest():
    # greedy alone: 6+3 (gap 1); the pair 2+2 fills the bin instead of the 3
    fill, _, bins = lay_out({6: 1, 3: 1, 2: 2}, 10)
    assert sorted(x for _, x in fill[0]) == [2, 2, 6] and bins == 2


def test_near_the_lower_bound_on_many_pieces():
    rng = np.random.default_rng(5)
    lengths = np.clip(rng.lognormal(5.5, 1.0, 200_000).astype(int), 1, 1024)
    bins = check(dict(Counter(lengths.tolist())), 1024)
    assert bins <= 1.002 * lengths.sum() / 1024 + 1


def brute(rows, capacity, end_id):
    lib = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for doc_id, text in rows:
        ids = lib.encode(text or "", add_special_tokens=False).ids + [end_id]
        at, piece = 0, 0
        n = len(ids) % capacity or capacity
        while at < len(ids):
            part = ids[at:at + n]
            want[doc_id, piece, at, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())] += 1
            at, piece, n = at + n, piece + 1, capacity
    return want


def verify(out, rows, capacity=1024, end_id=2):
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out)
    assert got == brute(rows, capacity, end_id)
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = op5_best_fit_packing(spark, sf).collect()
    bins = verify(out, rows)
    assert bins <= 1.03 * sum(r.length for r in out) / 1024 + 1


def test_edges(spark, make_docs):
    rows = [(1, None), (2, ""), (3, "a b c " * 5000), (4, "x"), (4, "x"), (None, "hot text")] + [
        (10 + i, "hot text") for i in range(500)]
    out = packing.pack_documents(make_docs(rows, 5), tokenizer_path(), capacity=64).collect()
    verify(out, rows, 64)
    assert packing.pack_documents(make_docs([(1, "a")]).limit(0), tokenizer_path()).count() == 0
