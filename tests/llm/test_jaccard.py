"""Signature-tree join against all pairs."""
import random
from collections import defaultdict

import numpy as np

from regmine.llm import jaccard
from regmine.llm.queries import ORACLE, op4_jaccard_join
from regmine.plans.verify import compare, duck_connect


def shingles(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    if len(w) < 5:
        return frozenset([(len(w), *w)])
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def root(parent, i):
    while parent[i] != i:
        i = parent[i]
    return i


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and (a == b or rows[i][0] is not None and rows[j][0] is not None) \
                    and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(parent, i)] = root(parent, j)
    low = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(parent, i)].append(d)
    return sorted(((d if d is not None else -1), len(s), min(low[root(parent, i)], default=-1))
                  for i, ((d, _), s) in enumerate(zip(rows, sets)))


def run(docs):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles,
                   r.component_id if r.component_id is not None else -1) for r in jaccard.near_copies(docs).collect())


def corpus(seed=5):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, passage = [], " ".join(r.choice(vocab) for _ in range(30))
    for g in range(30):
        base = [r.choice(vocab) for _ in range(r.choice([6, 25, 60, 200]))]
        for _ in range(r.choice([1, 2, 5, 20])):
            words = list(base)
            for _ in range(int(len(words) * r.choice([0, 0.01, 0.02, 0.04, 0.08]))):
                words[r.randrange(len(words))] = r.choice(vocab)
            if r.random() < 0.3:
                words += passage.split()
            rows.append((len(rows), " ".join(words).title() if r.random() < 0.2 else "  ".join(words)))
    return rows


def test_random_corpus(spark, make_docs, monkeypatch):
    rows = corpus()
    assert run(make_docs(rows)) == brute(rows)


def test_edges(spark, make_docs):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A  B"), (6, "a b c"), (7, "é x y z w v"),
            (8, "É x y z w v"), (None, "q w e r t y u"), (9, "q w e r t y u"), (10, "Q w e r t y u"),
            (11, "one two three four five"), (11, "one two three four five"), (None, "lonely"),
            (20, " ".join(f"x{i}" for i in range(30_000))), (21, " ".join(f"x{i}" for i in range(29_000)))]
    assert run(make_docs(rows)) == brute(rows)
    assert jaccard.near_copies(make_docs(rows).limit(0)).count() == 0


def test_blocks_of_a_large_group(spark, make_docs, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    monkeypatch.setattr(jaccard, "RUN", 4)
    rows = corpus(9)
    assert run(make_docs(rows)) == brute(rows)


def test_large_groups_by_size_range(spark, make_docs, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    monkeypatch.setattr(jaccard, "RUN", 4)
    monkeypatch.setattr(jaccard, "SPLIT", 5)
    monkeypatch.setattr(jaccard, "COMMON", 2)
    monkeypatch.setattr(jaccard, "BUCKETS", 1 << 14)
    rows = corpus(13)
    assert run(make_docs(rows)) == brute(rows)


def batches_of(rows, size):
    import pyarrow as pa
    for i in range(0, len(rows), size):
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i:i + size])],
                                         names=["token", "nid", "n", "pos", "comp"])


def test_rows_with_a_partner(monkeypatch):
    r = random.Random(4)
    rows = sorted((r.randrange(12), i, r.randrange(1, 60), 0, r.randrange(3)) for i in range(150))
    rows = sorted(((t, i, n, r.randrange(jaccard.prefix_length(n)), c) for t, i, n, _, c in rows),
                  key=lambda x: (x[0], x[2], x[1]))

    def may(x, y):
        return (x[0] == y[0] and x[4] != y[4] and 100 * min(x[2], y[2]) >= 80 * max(x[2], y[2])
                and 1 + x[2] - 1 - x[3] >= jaccard.needed(x[2], y[2]))
    want = [x for x in rows if any(may(x, y) for y in rows)]
    for size in (1, 3, 7, 150):
        got = [tuple(x.values()) for b in jaccard._test_groups(batches_of(rows, size)) for x in b.to_pylist()]
        assert got == want
    # a group too long to hold passes whole
    monkeypatch.setattr(jaccard, "HELD", 4)
    got = [tuple(x.values()) for b in jaccard._test_groups(batches_of(rows, 3)) for x in b.to_pylist()]
    assert len(got) == len(set(got)) and set(want) <= set(got)


def test_frequent_shingles_last(spark, make_docs, monkeypatch):
    monkeypatch.setattr(jaccard, "HOT_COUNT", 2)
    monkeypatch.setattr(jaccard, "PROBE", 1)
    rows = corpus(11)
    assert run(make_docs(rows)) == brute(rows)


def test_pairs_of_a_large_family(spark, make_docs, monkeypatch):
    """The first round connects a family of near copies whose links are spread
    thinly: the pairs left to the second do not grow with its square."""
    links, made = jaccard._links, {}

    def counted(src, classes, pairs, tag):
        pairs = pairs.cache()
        made[tag, size] = pairs.count()
        return links(src, classes, pairs, tag)

    monkeypatch.setattr(jaccard, "_links", counted)
    r = random.Random(21)
    base = [f"w{r.randrange(300)}" for _ in range(150)]
    rows = []
    for i in range(320):
        words = list(base)
        for j in range(r.choice([1, 1, 2])):
            words[r.randrange(len(words))] = f"e{i}x{j}"
        rows.append((i, " ".join(words)))
    for size in (160, 320):
        assert run(make_docs(rows[:size])) == brute(rows[:size])
        assert made["first", size] <= 8 * size        # a spanning forest for each shingle it deals by
    assert made["rest", 320] <= 3 * made["rest", 160] + 320


def test_tree_loses_no_pair():
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 1 << 62, int(rng.integers(1, 300)), dtype=np.uint64)
        for _ in range(4):
            s = base.copy()
            hit = rng.random(len(s)) < rng.choice([0.0, 0.05, 0.1, 0.15])
            s[hit] = rng.integers(0, 1 << 62, int(hit.sum()), dtype=np.uint64)
            sets.append(np.unique(s))
    sets.sort(key=len)
    sizes = np.array([len(s) for s in sets])
    i, j, _ = jaccard.candidates(sizes, [jaccard.bitmap(s) for s in sets], np.arange(len(sets)))
    got = set(zip(i.tolist(), j.tolist()))
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (sizes[i] + sizes[j] - both):
                assert (i, j) in got


def test_long_text_by_blocks(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000)).encode()
    whole = list(jaccard.shingle_sets([text]))[0]
    monkeypatch.setattr(jaccard, "TEXT_BLOCK", 100)
    assert (list(jaccard.shingle_sets([b"x", text]))[1] == whole).all()


def test_drop(spark, make_docs):
    docs = make_docs([(3, "a b c d e f"), (1, "a b c d e f"), (2, "z"), (4, None), (5, None)])
    left = jaccard.drop_near_copies(docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 2, 4, 5]


def test_drop_tells_rows_apart_by_id_and_text(spark, make_docs):
    words = [f"w{i}" for i in range(40)]
    b, near, far = " ".join(words), " ".join(words[:39] + ["x"]), " ".join(words[:38] + ["x", "y"])
    lone, lone2 = " ".join(f"n{i}" for i in range(40)), " ".join(f"n{i}" for i in range(39))
    rows = [(5, "a text that is no copy of any other"), (5, b), (3, near), (None, far), (None, lone), (None, lone2),
            (None, None), (8, "")]
    left = jaccard.drop_near_copies(make_docs(rows)).collect()
    got = sorted((r.doc_id or 0, r.text or "") for r in left)
    assert [r for r in got if r[0]] == [(3, near), (5, "a text that is no copy of any other"), (8, "")]
    null = [t for i, t in got if not i]
    assert len(null) == 2 and "" in null and (lone in null) != (lone2 in null)


def test_query_against_sql(spark, sf):
    r = compare(op4_jaccard_join(spark, sf), ORACLE["op4_jaccard_join"], duck_connect(sf))
    assert r["match"], r
