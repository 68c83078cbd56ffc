"""Positional index against a scan of every window."""
import hashlib
import random
import re

import pytest

from regmine.llm import decontamination as D
from regmine.llm.queries import ORACLE, op13_decontamination
from regmine.plans.verify import compare, duck_connect


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window):
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, passage in items:
            p = words(passage)
            k = min(window, len(p))
            for s in range(len(p) - k + 1) if k else ():
                for at in range(len(w) - k + 1):
                    if w[at:at + k] == p[s:s + k]:
                        hit.update(range(at, at + k))
                        found |= {str(item)} if item is not None else set()
        ids = ",".join(sorted(found))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def near(docs, items, window, slack):
    """Windows that stand in a document within window + slack words."""
    out = set()
    for i, text in docs:
        w = words(text)
        for item, passage in items:
            p = words(passage)
            k = min(window, len(p))
            for s in range(len(p) - k + 1) if k else ():
                need = set(p[s:s + k])
                if any(need <= set(w[at:at + k + slack]) for at in range(len(w))):
                    out.add((i, item))
    return out


def tables(spark, make_docs, docs, items):
    bench = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, row string, n int")
    return make_docs(docs), bench.repartition(2)


def corpus(seed, alphabet="a b c d Ä é7".split()):
    r = random.Random(seed)
    text = lambda n: " ".join(r.choice(alphabet) for _ in range(n))
    items = [(k, text(r.randrange(1, 12))) for k in range(12)] + [
        (3, "a b c d a b"), (20, None), (21, ""), (22, " ...! "), (None, "Zz zz zz"), (23, "absent words only here")]
    docs = [(i, text(r.randrange(0, 60))) for i in range(40)] + [
        (100, None), (101, ""), (None, "a, b; c! d a b"), (7, "A b\tC d\nA-B"), (7, "A b\tC d\nA-B"), (102, "zz ZZ_zz"),
        (103, text(3) + " " + " ".join(["b a"] * 60))]
    return docs, items


@pytest.mark.parametrize("shard, block, window", [(1 << 22, 1 << 19, 4), (40, 25, 4), (1, 1, 3)])
def test_equals_scan(spark, make_docs, monkeypatch, shard, block, window):
    monkeypatch.setattr(D, "SHARD", shard)
    monkeypatch.setattr(D, "BLOCK", block)
    docs, items = corpus(shard)
    df, bench = tables(spark, make_docs, docs, items)
    index = D.build_index(df)
    got = D.contamination(index, D.phrase_matches(index, bench, window)).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items, window)


def test_proximity(spark, make_docs):
    docs, items = corpus(9, alphabet=[f"w{i}" for i in range(14)])
    df, bench = tables(spark, make_docs, docs, items)
    index = D.build_index(df)
    found = D.proximity_matches(index, bench, 5, 3).join(index.documents, "row").collect()
    assert {(r.doc_id, r.item_id and int(r.item_id)) for r in found} == near(docs, items, 5, 3) != set()
    text = {}
    for i, t in docs:
        text.setdefault(i, words(t))
    for r in found:
        assert 0 < r.end - r.start <= 8 and r.end <= len(text[r.doc_id])
    with pytest.raises(ValueError):
        D.proximity_matches(index, bench, 60, 10)


def test_long_texts_are_cut_and_matches_cross_the_cuts(spark, make_docs, monkeypatch):
    r = random.Random(4)
    long = " ".join(r.choice("abcd") for _ in range(3000))
    docs = [(1, long), (2, "x" * 5000 + " " + long[:500]), (3, "q " * 700)]
    items = [(k, " ".join(long.split()[s:s + 12])) for k, s in enumerate(range(0, 2980, 97))] + [(99, long), (98, "q " * 300)]

    def cut(text):                                    # executors are other processes: cut here, compare there
        return [w.decode() for p in D.pieces(text.encode()) for w in p]

    whole = cut(long)
    monkeypatch.setattr(D, "PIECE", 64)
    assert cut(long) == whole and cut("x" * 500 + " y") == ["x" * 500, "y"] and cut("") == [] and cut(" .") == []
    monkeypatch.setattr(D, "SHARD", 200)
    df, bench = tables(spark, make_docs, docs, items)
    index = D.build_index(df)
    got = D.contamination(index, D.phrase_matches(index, bench)).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items, 10)


def test_shards_share_words_where_a_document_is_cut(monkeypatch):
    shard = D.Shard()
    shard.begin(5, 0)
    shard.extend([b"a", b"b", b"a"])
    shard.begin(6, 2)
    shard.extend([b"b"])
    terms, counts, data = shard.columns()
    assert terms == [b"", b"a", b"b"] and counts == [0, 2, 2]
    import numpy as np
    lists = [np.cumsum(np.frombuffer(x, "<i4")).tolist() for x in data.to_pylist()[1:]]
    assert lists == [[64, 66], [65, 131]]


def test_empty_tables(spark, make_docs):
    docs, items = [(1, "a b c")], [(1, "a b")]
    df, bench = tables(spark, make_docs, docs, items)
    index = D.build_index(df.where("false"))
    assert D.contamination(index, D.phrase_matches(index, bench)).collect() == []
    index = D.build_index(df)
    assert [r.n_hit for r in D.contamination(index, D.phrase_matches(index, bench.where("false"))).collect()] == [0]


def test_query_against_sql(spark, sf):
    r = compare(op13_decontamination(spark, sf), ORACLE["op13_decontamination"], duck_connect(sf))
    assert r["match"], r
