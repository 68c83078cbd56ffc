"""Permutation, shards and their records."""
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from regmine.llm import training_order
from regmine.llm.common import tokenizer_path
from regmine.llm.queries import op7_training_order


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation(size):
    a = training_order.feistel(np.arange(size), size, 7)
    assert sorted(a.tolist()) == list(range(size))
    if size > 60:
        assert (a != training_order.feistel(np.arange(size), size, 8)).any()
        assert abs(np.corrcoef(np.arange(size), a)[0, 1]) < 0.3


def verify(out, rows, stride):
    lib = Tokenizer.from_file(tokenizer_path())
    want = sorted(tuple(lib.encode(t or "", add_special_tokens=False).ids + [2]) for _, t in rows)
    assert sorted(r.slot for r in out) == list(range(len(out)))
    order = sorted(out, key=lambda r: r.slot)
    assert [(r.shard, r.record) for r in order] == sorted((r.shard, r.record) for r in out)
    streams, by_shard = defaultdict(dict), defaultdict(list)
    for r in order:
        by_shard[r.path].append(r)
    for path, rs in by_shard.items():
        data = training_order.read_records(path, 0, len(rs) + 5, stride)
        assert len(data) == len(rs)
        assert (training_order.read_records(path, len(rs) - 1, 1, stride)[0] == data[-1]).all()
        for r in rs:
            streams[r.part][r.idx] = data[r.record][:r.n_tokens]
    docs = []
    for part in streams.values():
        assert sorted(part) == list(range(len(part)))
        ids = np.concatenate([part[i] for i in range(len(part))]).tolist()
        at = 0
        while at < len(ids):
            # documents may hold the end mark's id as an ordinary one: match whole documents
            end = next(e for e in range(at + 1, len(ids) + 1) if ids[e - 1] == 2 and tuple(ids[at:e]) in set(want))
            docs.append(tuple(ids[at:end]))
            at = end
    assert sorted(docs) == want


def test_query(spark, sf):
    out = op7_training_order(spark, sf).collect()
    n = sum(r.n_tokens for r in out)
    lib = Tokenizer.from_file(tokenizer_path())
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert n == sum(len(lib.encode(t, add_special_tokens=False).ids) + 1 for t in texts)
    assert sorted(r.slot for r in out) == list(range(len(out)))


def test_edges(spark, make_docs):
    rows = [(1, None), (2, ""), (3, "one two three " * 40), (4, "x"), (4, "x"), (None, "hello world")] + [
        (10 + i, f"text number {i}") for i in range(60)]
    out = training_order.materialise(make_docs(rows, 4), tokenizer_path(), key=5, stride=16, shard_places=7).collect()
    assert len({r.shard for r in out}) > 3
    verify(out, rows, 16)
    empty = make_docs([(1, "a")]).limit(0)
    assert training_order.materialise(empty, tokenizer_path(), key=5).count() == 0


def test_ids_beyond_the_width_are_an_error(spark, make_docs):
    docs = make_docs([(1, "several ordinary words have larger ids")])
    with pytest.raises(Exception, match="give a larger width"):
        training_order.materialise(docs, tokenizer_path(), key=3, stride=8, width=1).count()
