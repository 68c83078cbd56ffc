"""Itemsets and rules on literal baskets, plus metamorphic checks."""

import pytest
from pyspark.sql import functions as F

from regmine.operators import itemsets as I
from regmine.operators import rules as R
from regmine.operators import vertical as V

MINERS = [I.apriori, V.apriori_bitmaps, I.fp_growth]


def baskets(spark, rows):
    return spark.createDataFrame([(i, sorted(set(r))) for i, r in enumerate(rows)], "tx_id long, items array<string>")


def as_dict(itemsets):
    return {tuple(r["items"]): r["freq"] for r in itemsets.collect()}


def test_itemsets_min_count_2(spark):
    tx = baskets(spark, [["a", "b"], ["a", "b", "c"], ["a"], ["b", "c"]])
    got = as_dict(I.apriori(tx, 2, 3).itemsets)
    assert got == {("a",): 3, ("b",): 3, ("c",): 2, ("a", "b"): 2, ("b", "c"): 2}
    assert as_dict(I.fp_growth(tx, 2, 3).itemsets) == got


def test_rules_single_item(spark):
    tx = baskets(spark, [["a", "b"], ["a", "b", "c"], ["a"], ["b", "c"]])
    m = I.apriori(tx, 2, 3)
    rules = {(tuple(r.antecedents), tuple(r.consequents)): (round(r.confidence, 6), round(r.lift, 6))
             for r in R.generate_rules(m.itemsets, m.n_transactions, 0.5).collect()}
    assert rules[(("a",), ("b",))][0] == round(2 / 3, 6)
    assert rules[(("b",), ("a",))][0] == round(2 / 3, 6)
    assert rules[(("b",), ("c",))][0] == round(2 / 3, 6)
    assert rules[(("c",), ("b",))] == (1.0, round(4 / 3, 6))


def test_rules_two_item_consequent(spark):
    tx = baskets(spark, [["a", "b", "c"], ["a", "b", "c"], ["a"], ["b"]])
    m = I.apriori(tx, 2, 3)
    keys = {(tuple(r.antecedents), tuple(r.consequents)) for r in R.generate_rules(m.itemsets, 4, 0.0).collect()}
    assert (("a", "b"), ("c",)) in keys and (("c",), ("a", "b")) in keys


def test_item_value_with_comma(spark):
    tx = baskets(spark, [["MUNICIPIO=X, Y", "SEXO=H"]] * 3)
    m = I.apriori(tx, 2, 3)
    r = R.single_consequent(R.generate_rules(m.itemsets, m.n_transactions, 0.5))
    assert {tuple(x.consequents) for x in r.collect()} == {("MUNICIPIO=X, Y",), ("SEXO=H",)}


def test_support_antimonotone_and_partition_invariance(spark):
    import random
    rnd = random.Random(7)
    rows = [[f"i{rnd.randint(0, 6)}" for _ in range(4)] for _ in range(300)]
    tx = baskets(spark, rows)
    a = as_dict(I.apriori(tx.repartition(1), 0.05, 3).itemsets)
    b = as_dict(I.apriori(tx.repartition(5), 0.05, 3).itemsets)
    assert a == b
    for items, f in a.items():
        for i in range(len(items)):
            sub = items[:i] + items[i + 1:]
            if sub:
                assert a[sub] >= f
    assert as_dict(I.fp_growth(tx, 0.05, 3).itemsets) == a


def test_transactions_skip_null_empty_nan(spark):
    df = spark.createDataFrame([(" x ", None, "nan"), ("y", "", "z")], "A string, B string, C string")
    got = [r["items"] for r in I.to_transactions(df, ["A", "B", "C"]).collect()]
    assert got == [["A=x"], ["A=y", "C=z"]]


def test_lift_symmetric(spark):
    tx = baskets(spark, [["a", "b"], ["a", "b", "c"], ["a"], ["b", "c"], ["c"]])
    m = I.apriori(tx, 1, 2)
    r = {(tuple(x.antecedents), tuple(x.consequents)): x.lift
         for x in R.generate_rules(m.itemsets, m.n_transactions, 0.0).collect()}
    for (a, c), lift in r.items():
        assert abs(r[(c, a)] - lift) < 1e-12


def brute(rows, min_count, max_k):
    from collections import Counter
    from itertools import combinations
    out = Counter()
    for r in rows:
        for k in range(1, max_k + 1):
            out.update(combinations(sorted(set(r)), k))
    return {s: n for s, n in out.items() if n >= min_count}


def test_against_brute_force_and_candidate_counts(spark):
    import random
    rnd = random.Random(3)
    rows = [[f"i{rnd.randint(0, 11)}" for _ in range(9)] for _ in range(200)] + [[]]
    tx = baskets(spark, rows)
    m = I.apriori(tx, 20, 4)
    assert as_dict(m.itemsets) == brute(rows, 20, 4)
    assert all(r.candidates is not None for r in m.levels.collect() if r.k > 1)
    assert m.n_transactions == len(rows)


def test_one_wide_basket_among_narrow_ones(spark):
    import random
    rnd = random.Random(5)
    rows = [[f"i{rnd.randint(0, 30)}" for _ in range(3)] for _ in range(300)] + [[f"i{i}" for i in range(200)]]
    m = I.apriori(baskets(spark, rows), 5, 3)
    assert as_dict(m.itemsets) == {s: n for s, n in brute(rows[:-1] + [rows[-1][:31]], 5, 3).items()}
    assert all(r.candidates is not None for r in m.levels.collect() if r.k > 1)


def test_count_support_of_given_candidates(spark):
    tx = baskets(spark, [["a", "b", "c", "d"], ["b", "c"], ["a", "c", "d"]])
    cand = spark.createDataFrame([(["a", "c", "d"],), (["a", "b", "d"],), (["b", "c", "z"],)], "items array<string>")
    got = {tuple(r["items"]): r.freq for r in I.count_support(tx, cand, 3, 1).collect()}
    assert got == {("a", "c", "d"): 2, ("a", "b", "d"): 1}
    pairs = {tuple(r["items"]) for r in I.generate_candidates(I.frequent_items(tx, 2), 2).collect()}
    assert pairs == {("a", "b"), ("a", "c"), ("a", "d"), ("b", "c"), ("b", "d"), ("c", "d")}


def test_encoding_keeps_every_item(spark):
    rows = [["b", "a"], [], ["c"], ["a", "c"]]
    enc, items = I.encode_transactions(baskets(spark, rows))
    index = {r.item: r["index"] for r in items.collect()}
    assert index == {"a": 0, "b": 1, "c": 2}
    assert {r.tx_id: r.indices for r in enc.collect()} == {0: [0, 1], 1: [], 2: [2], 3: [0, 2]}
    assert {r.item: r["count"] for r in I.item_totals(enc, items).collect()} == {"a": 2, "b": 1, "c": 2}


@pytest.mark.parametrize("few", [256, 0])
def test_miners_agree_on_both_encodings(spark, monkeypatch, few):
    import random
    monkeypatch.setattr(I, "LITERAL_ITEMS", few)
    rnd = random.Random(11)
    rows = [[f"i{rnd.randint(0, 13)}" for _ in range(rnd.randint(0, 9))] for _ in range(2500)]
    tx = baskets(spark, rows).repartition(3)
    want = brute(rows, 60, 4)
    for mine in MINERS:
        m = mine(tx, 60, 4)
        assert as_dict(m.itemsets) == want and m.n_transactions == 2500 and m.min_count == 60


@pytest.mark.parametrize("mine", MINERS)
def test_empty_and_hopeless_input(spark, mine):
    tx = baskets(spark, [["a"], ["b"], []])
    assert mine(tx, 2, 3).itemsets.collect() == [] and mine(tx.where("false"), 0.5, 3).itemsets.collect() == []
    assert as_dict(mine(tx, 1, 1).itemsets) == {("a",): 1, ("b",): 1}


@pytest.mark.parametrize("mine", MINERS)
def test_no_length_limit(spark, mine):
    tx = baskets(spark, [["a", "b", "c", "d", "e"]] * 3 + [["a", "c"]] * 2)
    got = as_dict(mine(tx, 3, None).itemsets)
    assert len(got) == 31 and got[("a", "c")] == 5 and got[("a", "b", "c", "d", "e")] == 3


def test_a_million_copies_are_expanded_once(spark):
    """Weighted baskets: as many rows as there are different baskets."""
    kinds = F.array(F.lit("a"), F.lit("b"), F.concat(F.lit("c"), (F.col("id") % 3).cast("string")),
                    F.concat(F.lit("rare"), F.col("id").cast("string")))
    tx = spark.range(1_000_000).select(F.array_sort(kinds).alias("items"))
    written, codes, n, least = I.frequent_codes(tx, 0.02)
    folded = I.weighted_baskets(written, codes)
    assert n == 1_000_000 and codes.n == 5 and sorted(r.w for r in folded.collect()) == [333333, 333333, 333334]
    want = as_dict(I.level_wise(codes, n, least, 3, lambda c, k, m: I.count_support(folded, c, k, least, "w", m)).itemsets)
    assert len(want) == 5 + 7 + 3 and want[("a", "b")] == 1_000_000


def test_growth_stops_at_the_length_asked_for(spark, monkeypatch):
    """18 items in every basket: 987 sets of up to 3 items, none longer made."""
    written = []
    keep = I.materialize

    def watched(df):
        out = keep(df)
        written.append((out.columns, out.count()))
        return out

    monkeypatch.setattr(I, "materialize", watched)
    rows = [[f"i{j:02}" for j in range(18)]] * 20
    sets = as_dict(I.fp_growth(baskets(spark, rows), 20, 3).itemsets)
    assert len(sets) == 987 and set(sets.values()) == {20}
    assert all("p4" not in cols for cols, _ in written) and max(n for _, n in written) <= 987


def test_bitmaps_count_across_blocks(spark, monkeypatch):
    rows = [["a", "b"] if i % 3 == 0 else ["a"] if i % 3 == 1 else ["b", "c"] for i in range(5000)]
    m = V.apriori_bitmaps(baskets(spark, rows).repartition(4), 1, 3)
    assert as_dict(m.itemsets) == brute(rows, 1, 3)
    assert {(r.k, r.candidates, r.frequent) for r in m.levels.collect()} == {(1, None, 3), (2, 3, 2), (3, 0, 0)}


def _rules(spark, sets, n, conf):
    df = spark.createDataFrame([(len(k), list(k), f) for k, f in sets.items()], "k int, items array<string>, freq long")
    return {(tuple(r.antecedents), tuple(r.consequents)): r for r in R.generate_rules(df, n, conf).collect()}


def test_rules_of_four_items_against_all_splits(spark):
    from itertools import combinations
    import random
    rnd = random.Random(8)
    rows = [[f"i{j}" for j in range(6) if rnd.random() < 0.6] for _ in range(120)]
    sets = brute(rows, 6, 5)
    for conf in (0.0, 0.55, 1.0):
        want = {(a, tuple(x for x in z if x not in a)) for z in sets for m in range(1, len(z))
                for a in combinations(z, m) if sets[z] / sets[a] >= conf}
        got = _rules(spark, sets, len(rows), conf)
        assert set(got) == want
        for (a, c), r in got.items():
            assert r.freq == sets[tuple(sorted(a + c))] and abs(r.lift - r.confidence * 120 / sets[c]) < 1e-9


def test_rules_of_a_long_itemset(spark):
    """A set of 40 items: consequents that fail are not extended."""
    items = [f"i{j:02}" for j in range(40)]
    sets = {(i,): 100 for i in items} | {tuple(items): 10}
    sets |= {tuple(x for x in items if x != i): 11 if i in items[:2] else 90 for i in items}
    sets[tuple(items[2:])] = 12
    got = _rules(spark, sets, 100, 0.8)
    rest = tuple(items[2:])
    want = {(tuple(x for x in items if x != i), (i,)) for i in items[:2]} | {(rest, (i,)) for i in items[:2]}
    assert set(got) == want
    sets[tuple(items[:2])] = 100
    got = _rules(spark, sets, 100, 0.8)
    pair = {(items[0],): (items[1],), (items[1],): (items[0],)}
    assert set(got) == want | {(rest, tuple(items[:2]))} | set(pair.items())


def test_rules_of_nothing(spark):
    assert _rules(spark, {("a",): 3}, 3, 0.5) == {} and _rules(spark, {("a", "b"): 1}, 3, 0.5) == {}
