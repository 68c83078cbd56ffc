"""Byte shards: whole, balanced, gapless, contiguous."""
import zlib
from collections import defaultdict

from regmine.llm import sharding
from regmine.llm.queries import op8_byte_shards


def verify(out, rows, n):
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in out) == sorted(
        (i or -1, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    shards = defaultdict(list)
    for r in out:
        shards[r.shard].append(r)
        assert r.law == "bytes" and r.grown_shard is None
    total, top = sum(r.size for r in out), max(r.size for r in out)
    at = 0
    for s in sorted(shards):
        part = sorted(shards[s], key=lambda r: r.slot)
        assert [r.slot for r in part] == list(range(len(part)))
        for r in part:
            assert r.first_byte == at
            at += r.size
        assert abs(sum(r.size for r in part) - total / n) <= top
    assert 0 <= min(shards) and max(shards) < n


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    verify(op8_byte_shards(spark, sf).collect(), rows, 24)


def test_edges(spark, make_docs):
    rows = [(1, None), (2, ""), (None, "é" * 50), (4, "x"), (4, "x")] + [(10 + i, "hot" * 9) for i in range(300)]
    verify(sharding.shard_by_bytes(make_docs(rows), 5).collect(), rows, 5)
    assert sharding.shard_by_bytes(make_docs(rows).limit(0), 5).count() == 0
    assert {r.shard for r in sharding.shard_by_bytes(make_docs([(1, "a")]), 24).collect()} <= set(range(24))
