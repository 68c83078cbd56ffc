"""Trie owners against a dictionary, spilling included."""
import hashlib
import random
from collections import defaultdict

from regmine.llm import dedup
from regmine.plans.verify import compare, duck_connect


def test_trie_against_dictionary_with_spills():
    r = random.Random(2)
    for limit in (300, 2000, 1 << 30):
        trie, want = dedup.PatriciaTrie(lambda a, b: a + b, limit), defaultdict(int)
        for _ in range(4000):
            key = b"prefix" * r.randint(0, 3) + bytes(r.choice(b"ab") for _ in range(r.randint(0, 9)))
            trie.insert(key, (1,))
            want[key] += 1
        assert sorted(len(v) for v in trie.items()) == sorted(want.values())


def test_one_string_over_the_limit():
    trie = dedup.PatriciaTrie(lambda a, b: a + b, 100)
    for _ in range(5):
        trie.insert(b"x" * 1000, (1,))
        trie.insert(b"x" * 999 + b"y", (1,))
    assert sorted(len(v) for v in trie.items()) == [5, 5]


def brute(rows, largest=True):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").encode().lower()].append(i)
    out = {}
    for text, ids in groups.items():
        some = [i for i in ids if i is not None]
        keep = (max(some) if largest else min(some)) if some else None
        out[text] = (keep, len(ids))
    return out


def test_edges(spark, make_docs, monkeypatch):
    rows = [(1, None), (2, ""), (3, "Ab É"), (4, "aB É"), (5, "ab é"), (None, "ab É"), (7, "z" * 100_000),
            (8, "Z" * 100_000), (9, "only"), (9, "only"), (None, "n"), (None, "N")]
    rows += [(100 + i, "hot") for i in range(400)]
    for keep in ("largest", "smallest"):
        out = dedup.exact_duplicates(make_docs(rows, 7), keep=keep).collect()
        assert len(out) == len(rows)
        want = {hashlib.sha256(t).hexdigest(): v for t, v in brute(rows, keep == "largest").items()}
        for r in out:
            assert (r.keep_id, r.group_size) == want[r.text_sha256]
        kept = defaultdict(int)
        for r in out:
            kept[r.text_sha256] += r.kept
            assert not r.kept or r.doc_id == r.keep_id
        assert set(kept.values()) == {1} and len(kept) == len(want)
    assert dedup.exact_duplicates(make_docs(rows).limit(0)).count() == 0


def test_drop(spark, make_docs):
    docs = make_docs([(1, "a"), (2, "A"), (3, "b"), (None, None), (None, "B"), (None, "c"), (2, "z"), (4, "É"), (5, "é")])
    left = dedup.drop_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id or 0), r.text or "") for r in left.collect()) == [
        (0, ""), (0, "c"), (2, "A"), (2, "z"), (3, "b"), (4, "É"), (5, "é")]


def test_drop_keeps_one_of_repeated_rows(spark, make_docs):
    rows = [(1, "a"), (9, "a"), (9, "a"), (9, "A"), (None, "n"), (None, "N"), (None, "n"), (None, "a"), (9, "b"), (4, "c")]
    docs = make_docs(rows)
    left = dedup.drop_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text.lower()) for r in left.collect()) == [(0, "n"), (4, "c"), (9, "a"), (9, "b")]
    assert dedup.drop_duplicates(docs, keep="smallest").count() == 4


def test_query_against_sql(spark, sf):
    from regmine.llm.queries import ORACLE, op6_exact_dedup
    r = compare(op6_exact_dedup(spark, sf), ORACLE["op6_exact_dedup"], duck_connect(sf))
    assert r["match"], r


def test_dropping_with_clashing_names_and_map_columns(spark):
    rows = [(1, "A b", "x", {"k": 1}), (2, "a B", "y", {"k": 2}), (2, "a B", "z", {"k": 3}), (None, "q", "u", None),
            (None, "Q", "v", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _text_hash string, _rank map<string,int>")
    left = dedup.drop_duplicates(docs.repartition(2))
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r["_text_hash"]) for r in left.collect()) in ([(0, "u"), (2, "y")], [(0, "v"), (2, "y")])


def test_a_text_of_very_many_folds():
    """Owners of one text from a million folds, in steps that do not grow."""
    import time

    import pyarrow as pa
    run = dedup._owners(pa.int64(), True)
    n = 200_000

    def batches():
        for at in range(0, n, 20_000):
            ids = range(at, at + 20_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array([b"text"] * 20_000, pa.binary()), pa.array(ids, pa.int64()), pa.array([0] * 20_000, pa.int64()),
                 pa.array([1] * 20_000, pa.int64()), pa.array(ids, pa.int64()), pa.array([0] * 20_000, pa.int64())],
                names=["text", "part", "fold", "n", "owner", "owner_row"])

    began = time.time()
    out = list(run(batches()))
    assert sum(b.num_rows for b in out) == n and time.time() - began < 30
    assert {v for b in out for v in b.column(2).to_pylist()} == {n - 1}
