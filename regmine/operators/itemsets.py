"""Frequent itemsets.

Three miners share the preparation and differ in how they count:

* ``apriori`` (I7) folds equal baskets, once infrequent items are gone, into one
  weighted basket; a level extends prefixes by one item at a time, ``(c1, rest)``
  -> ``(c1, c2, rest)`` -> ..., semi-joined with the prefixes of the candidates,
  and adds up weights;
* ``apriori_bitmaps`` (I8, ``operators.vertical``) keeps, per block of baskets and
  item, a bit for every basket and counts candidates by AND and bit count;
* ``fp_growth`` (I9) grows patterns from item-conditional projected baskets and
  stops at max_k.

Preparation: transactions are written once as Parquet and counted on that pass;
frequent items get integer codes in item order (a range-partitioned sort), so
later levels compare integers.  Counts use partially aggregated ``groupBy``s -- a
hot itemset is combined map-side before the shuffle.  Only level counts reach the
driver, and the item names while they are few (``LITERAL_ITEMS``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regmine.functions.numeric import broadcast_bounded, broadcast_checked, r6
from regmine.session import materialize, materialize_with

KEY_SEP = "\u0001"


def item_key(items: Column) -> Column:
    return F.array_join(items, KEY_SEP)


def to_transactions(df: DataFrame, cols: list[str], id_col: str | None = None) -> DataFrame:
    """One sorted, distinct item array per row: ``COL=stripped value``;
    null, empty and 'nan' values are skipped."""
    parts = []
    for c in cols:
        v = F.regexp_replace(F.col(c).cast("string"), r"(?U)^\s+|\s+$", "")
        parts.append(F.when(v.isNotNull() & (v != "") & (v != "nan"),
                            F.concat(F.lit(c + "="), v)))
    items = F.array_sort(F.array_distinct(F.array_compact(F.array(*parts))))
    sel = [F.col(id_col).alias("tx_id")] if id_col else []
    return df.select(*sel, items.alias("items"))


def explode_items(df: DataFrame, col: Column | str, name: str, *keep) -> DataFrame:
    """explode + null filter on the generated column.  Plain ``explode`` makes
    the optimizer infer ``size(col) > 0`` and push it below the generator,
    inlining the whole upstream expression tree into scans and joins; the
    outer form avoids that inference."""
    return df.select(*keep, F.explode_outer(col).alias(name)).where(F.col(name).isNotNull())


def transaction_items(tx: DataFrame) -> DataFrame:
    """I2 (long form): one (tx_id, item) row per membership."""
    return explode_items(tx, "items", "item", "tx_id")


def encode_transactions(tx: DataFrame):
    """Sparse binary encoding over all items.  Returns (encoded, items):
    ``encoded`` (tx_id, indices) with the sorted indices of each transaction's
    items (empty for an empty basket), ``items`` (item, index) numbering the
    items from 0 in item order.  Both are distributed; no item is dropped."""
    from regmine.operators.concentration import running_sums
    long_form = transaction_items(tx)
    names = materialize(long_form.select("item").distinct().withColumn("one", F.lit(1).cast("long")))
    items = running_sums(names, "item", ["one"]).select("item", (F.col("cum_one") - 1).alias("index"))
    items = materialize(items)
    found = (long_form.join(items, "item").groupBy("tx_id")
             .agg(F.array_sort(F.collect_set("index")).alias("indices")))
    none = F.array().cast("array<bigint>")
    return tx.select("tx_id").join(found, "tx_id", "left").select(
        "tx_id", F.coalesce("indices", none).alias("indices")), items


def item_totals(encoded: DataFrame, items: DataFrame) -> DataFrame:
    """Column sums of the sparse encoding, as (item, count)."""
    sums = explode_items(encoded, "indices", "index").groupBy("index").agg(F.count(F.lit(1)).alias("count"))
    return sums.join(items, "index").select("item", "count")


def min_count_for(min_support: float, n: int) -> int:
    """Absolute threshold: ceil(s * n) for a fraction, int(s) for a count."""
    return math.ceil(min_support * n) if 0 < min_support < 1 else int(min_support)


def subsets(tx: DataFrame, k: int, allowed: dict[int, DataFrame] | None = None, *keep: str) -> DataFrame:
    """Columns c1..ck (and ``keep``): every k-subset, in array order, of the
    sorted arrays in ``items``.  ``allowed[j]`` (columns c1..cj) keeps only those
    prefixes."""
    names = [f"c{j}" for j in range(1, k + 1)]
    cur = tx.where(F.size("items") >= k).select(F.col("items").alias("__rest"), *keep)
    for j in range(1, k + 1):
        cur = cur.select(*names[:j - 1], "__rest", *keep, F.posexplode("__rest").alias("__at", names[j - 1]))
        if j < k:
            cur = cur.where(F.size("__rest") - F.col("__at") > k - j).select(
                *names[:j], F.slice("__rest", F.col("__at") + 2, F.size("__rest")).alias("__rest"), *keep)
        else:
            cur = cur.select(*names, *keep)
        if allowed and j in allowed:
            cur = cur.join(allowed[j], names[:j], "left_semi")
    return cur


def _columns(sets: DataFrame, k: int) -> DataFrame:
    return sets.select(*[F.element_at("items", j).alias(f"c{j}") for j in range(1, k + 1)])


def frequent_items(tx: DataFrame, min_count: int) -> DataFrame:
    """Single items with count >= min_count as (k, items, freq)."""
    return (explode_items(tx, "items", "item").groupBy("item")
            .agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= min_count)
            .select(F.lit(1).alias("k"), F.array("item").alias("items"), "freq"))


def generate_candidates(prev: DataFrame, k: int) -> DataFrame:
    """I4: join frequent (k-1)-sets sharing their first k-2 items, last item
    ascending.  At k = 2 there is no common prefix to join on: the items are
    numbered and every item meets the numbers before its own."""
    if k == 2:
        from regmine.operators.concentration import running_sums
        one = prev.select(F.element_at("items", 1).alias("y"), F.lit(1).cast("long").alias("one"))
        # numbers of the frequent single items, by range partitions
        numbered = materialize(running_sums(one, "y", ["one"]).select("y", F.col("cum_one").alias("n")))
        earlier = (numbered.where("n > 1")
                   .select("y", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("m")))
        first = numbered.select(F.col("y").alias("x"), F.col("n").alias("m"))
        return earlier.join(first, "m").select(F.array("x", "y").alias("items"))
    a = prev.select(F.slice("items", 1, k - 2).alias("prefix"), F.element_at("items", -1).alias("x"))
    b = prev.select(F.slice("items", 1, k - 2).alias("prefix"), F.element_at("items", -1).alias("y"))
    return a.join(b, (a.prefix == b.prefix) & (a.x < b.y)).select(
        F.concat(a.prefix, F.array(a.x, b.y)).alias("items"))


def prune_candidates(cand: DataFrame, prev: DataFrame, k: int) -> DataFrame:
    """Keep candidates whose k subsets of size k-1 are all frequent
    (explode the subsets, equi-join the previous level, count = k)."""
    subs = cand.select("items", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("drop"))
    subs = subs.select("items", F.filter("items", lambda x, i: i != F.col("drop")).alias("sub"))
    known = prev.select(F.col("items").alias("sub"))
    ok = subs.join(known, "sub").groupBy("items").agg(F.count(F.lit(1)).alias("m"))
    return ok.where(F.col("m") == k).select("items")


def prefixes(cand: DataFrame, k: int, n_cand: int) -> dict[int, DataFrame]:
    """The candidates' prefixes of every length (columns c1..cj), broadcast if
    the ``n_cand`` candidates, which bound them all, are few."""
    names = [f"c{j}" for j in range(1, k + 1)]
    full = _columns(cand, k)
    out = {j: full.select(*names[:j]).distinct() for j in range(1, k)} | {k: full}
    return {j: broadcast_bounded(p, n_cand) for j, p in out.items()}


def count_support(tx: DataFrame, cand: DataFrame | None, k: int, min_count: int,
                  weight: str | None = None, n_cand: int | None = None) -> DataFrame:
    """Support of the candidates (of all k-subsets when ``cand`` is None):
    extend prefixes item by item, keep those of candidates, count (or add up
    ``weight``) with a partially aggregated groupBy, keep count >= min_count.
    ``cand`` without its number is written first, which counts it."""
    if cand is not None and n_cand is None:
        cand, seen = materialize_with(cand, n=F.count(F.lit(1)))
        n_cand = seen["n"]
    allowed = None if cand is None else prefixes(cand, k, n_cand)
    names = [f"c{j}" for j in range(1, k + 1)]
    rows = subsets(tx, k, allowed, *([weight] if weight else []))
    total = F.sum(weight) if weight else F.count(F.lit(1))
    counted = rows.groupBy(*names).agg(total.alias("freq"))
    return counted.where(F.col("freq") >= min_count).select(F.lit(k).alias("k"), F.array(*names).alias("items"), "freq")


@dataclass
class MiningResult:
    itemsets: DataFrame      # (k, items, freq, support)
    levels: DataFrame        # (k, candidates, frequent, pct_dropped)
    n_transactions: int
    min_count: int


_checkpoint = materialize

# Up to so many frequent items, their names travel as literals of the plan (one
# look-up per item, no join); beyond it baskets are encoded by a join.
LITERAL_ITEMS = 256


@dataclass
class Codes:
    """Frequent items (item, code, freq); codes rise with the item text."""
    table: DataFrame
    n: int
    names: dict | None       # {item: code} if they are few

    def encoded(self, tx: DataFrame, *keep: str) -> DataFrame:
        """``items`` as the sorted codes of the frequent items; rows without one
        are left out."""
        if self.names is not None:
            known = F.create_map(*[F.lit(x) for kv in self.names.items() for x in kv]) if self.names else None
            if known is None:
                return tx.select(F.array().cast("array<bigint>").alias("items"), *keep).where("false")
            found = F.array_compact(F.transform("items", lambda x: F.try_element_at(known, x)))
            return tx.select(found.alias("items"), *keep).where(F.size("items") > 0)
        rows = explode_items(tx.withColumn("__id", F.monotonically_increasing_id()), "items", "item", "__id", *keep)
        return (rows.join(broadcast_checked(self.table.select("item", "code")), "item").groupBy("__id", *keep)
                .agg(F.array_sort(F.collect_list("code")).alias("items")).select("items", *keep))

    def decoded(self, sets: DataFrame, k: int) -> DataFrame:
        """(k, items, freq) with item texts instead of codes."""
        if self.names is not None:
            text = F.create_map(*[F.lit(x) for item, code in self.names.items() for x in (code, item)])
            items = F.transform("items", lambda c: F.try_element_at(text, c))
            return sets.select(F.lit(k).alias("k"), items.alias("items"), "freq")
        cur = sets.select("freq", *[F.element_at("items", j).alias(f"c{j}") for j in range(1, k + 1)])
        for j in range(1, k + 1):
            cur = cur.join(self.table.select(F.col("code").alias(f"c{j}"), F.col("item").alias(f"i{j}")), f"c{j}")
        return cur.select(F.lit(k).alias("k"), F.array(*[f"i{j}" for j in range(1, k + 1)]).alias("items"), "freq")


def frequent_codes(tx: DataFrame, min_support: float) -> tuple[DataFrame, Codes, int, int]:
    """(written transactions, codes of their frequent items, number of
    transactions, absolute threshold)."""
    rows = F.count(F.lit(1))
    tx, seen = materialize_with(tx.select("items"), n=rows)
    n = seen["n"]
    min_count = min_count_for(min_support, n)
    counts = explode_items(tx, "items", "item").groupBy("item").agg(rows.alias("freq"))
    # a global sort is range-partitioned and ids rise from partition to partition
    table, seen = materialize_with(counts.where(F.col("freq") >= min_count).orderBy("item").select(
        "item", F.monotonically_increasing_id().alias("code"), "freq"), n=rows)
    n1 = seen["n"]
    names = {r["item"]: r["code"] for r in table.select("item", "code").collect()} if n1 <= LITERAL_ITEMS else None
    return tx, Codes(table, n1, names), n, min_count


def weighted_baskets(tx: DataFrame, codes: Codes) -> DataFrame:
    """(items, w): every different basket of frequent items once, with its
    number of transactions (combined map-side, so copies are not shuffled)."""
    return materialize(codes.encoded(tx).groupBy("items").agg(F.count(F.lit(1)).alias("w")))


def next_candidates(prev: DataFrame, n_prev: int, k: int) -> tuple[DataFrame | None, int]:
    """(candidates, their number) of level k; at level 2 every pair of frequent
    items is one, and no table is needed."""
    if k == 2:
        return None, n_prev * (n_prev - 1) // 2
    cand, seen = materialize_with(prune_candidates(generate_candidates(prev, k), prev, k), n=F.count(F.lit(1)))
    return cand, seen["n"]


def level_wise(codes: Codes, n: int, min_count: int, max_k: int | None, count) -> MiningResult:
    """The levels of Apriori; ``count(candidates or None, k, their number)`` gives
    the frequent ones as (k, items, freq).  Stops at max_k or when a level is empty."""
    spark = codes.table.sparkSession
    levels = [(1, None, codes.n)]
    out = [codes.table.select(F.lit(1).alias("k"), F.array("item").alias("items"), "freq")]
    prev, n_prev, k = codes.table.select(F.array("code").alias("items")), codes.n, 1
    while n_prev > 0 and (max_k is None or k < max_k):
        k += 1
        cand, n_cand = next_candidates(prev, n_prev, k)
        if n_cand == 0:
            levels.append((k, 0, 0))
            break
        prev, seen = materialize_with(count(cand, k, n_cand), n=F.count(F.lit(1)))
        n_prev = seen["n"]
        levels.append((k, n_cand, n_prev))
        if n_prev:
            out.append(codes.decoded(prev, k))
    lv = spark.createDataFrame(levels, "k int, candidates long, frequent long")
    lv = lv.select("k", "candidates", "frequent",
                   r6(F.when(F.col("candidates") > 0,
                             100.0 * (F.col("candidates") - F.col("frequent")) / F.col("candidates")))
                   .alias("pct_dropped"))
    return MiningResult(_with_support(out, n), lv, n, min_count)


def _with_support(levels: list[DataFrame], n: int) -> DataFrame:
    return reduce(DataFrame.unionByName, levels).select(
        "k", "items", "freq", (F.col("freq") / F.lit(float(n or 1))).alias("support"))


def apriori(tx: DataFrame, min_support: float = 0.02, max_k: int | None = 3) -> MiningResult:
    """Level-wise Apriori with candidate generation, subset pruning and
    support counting on weighted baskets."""
    tx, codes, n, min_count = frequent_codes(tx, min_support)
    baskets = weighted_baskets(tx, codes)
    return level_wise(codes, n, min_count, max_k,
                      lambda cand, k, m: count_support(baskets, cand, k, min_count, "w", m))


def fp_growth(tx: DataFrame, min_support: float = 0.02, max_k: int | None = 3) -> MiningResult:
    """Pattern growth.  A pattern's projected baskets are the parts before
    its first item, of the baskets that hold it, cut to the items frequent
    there and folded with their weights; an item frequent in them makes the next
    pattern.  All patterns of a length grow in one job, without candidates, and
    nothing longer than max_k is counted or projected."""
    tx, codes, n, min_count = frequent_codes(tx, min_support)
    out = [codes.table.select(F.lit(1).alias("k"), F.array("item").alias("items"), "freq")]
    db, k, n_prev = weighted_baskets(tx, codes), 1, codes.n
    found = codes.table.select(F.col("code").alias("c1"), "freq")
    while n_prev > 0 and (max_k is None or k < max_k):
        # columns of a pattern of k items, first item last found: p1 (first) .. pk
        tail = [f"p{j}" for j in range(2, k + 1)]
        part = db.select(*tail, "items", "w", F.posexplode("items").alias("__at", "p1")).where("__at > 0")
        before = F.slice("items", 1, F.col("__at"))
        if k > 1:
            grown = found.groupBy(*tail).agg(F.collect_list("p1").alias("__known"))   # at most codes.n items
            part = (part.join(broadcast_bounded(found.select("p1", *tail), n_prev), ["p1", *tail], "left_semi")
                    .join(broadcast_bounded(grown, n_prev), tail))
            before = F.array_intersect(before, "__known")
        db = part.select("p1", *tail, before.alias("items"), "w").where(F.size("items") > 0)
        k += 1
        # the projection of the patterns of k - 1 items, whose columns move up by one
        db = db.select(*[F.col(f"p{j - 1}").alias(f"p{j}") for j in range(2, k + 1)], "items", "w")
        tail = [f"p{j}" for j in range(2, k + 1)]
        if max_k is None or k < max_k:
            db = materialize(db.groupBy(*tail, "items").agg(F.sum("w").alias("w")))
        counted = (db.select(*tail, "w", F.explode("items").alias("p1")).groupBy("p1", *tail)
                   .agg(F.sum("w").alias("freq")).where(F.col("freq") >= min_count))
        found, seen = materialize_with(counted, n=F.count(F.lit(1)))
        n_prev = seen["n"]
        if n_prev:
            sets = found.select(F.array("p1", *tail).alias("items"), "freq")
            out.append(codes.decoded(sets, k))
    allsets = _with_support(out, n)
    lv = allsets.groupBy("k").agg(F.count(F.lit(1)).alias("frequent")).select(
        "k", F.lit(None).cast("long").alias("candidates"), "frequent",
        F.lit(None).cast("double").alias("pct_dropped"))
    return MiningResult(allsets, lv, n, min_count)


def compare_itemsets(a: DataFrame, b: DataFrame) -> DataFrame:
    """(only_a, only_b, common) over (items, freq) rows, multiset
    semantics, in one grouped pass (no joins)."""
    tagged = (a.select(item_key("items").alias("key"), "freq", F.lit(1).alias("ia"), F.lit(0).alias("ib"))
              .unionByName(b.select(item_key("items").alias("key"), "freq", F.lit(0).alias("ia"),
                                    F.lit(1).alias("ib"))))
    g = tagged.groupBy("key", "freq").agg(F.sum("ia").alias("ca"), F.sum("ib").alias("cb"))
    return g.agg(F.coalesce(F.sum(F.greatest(F.col("ca") - F.col("cb"), F.lit(0))), F.lit(0))
                 .cast("long").alias("only_a"),
                 F.coalesce(F.sum(F.greatest(F.col("cb") - F.col("ca"), F.lit(0))), F.lit(0))
                 .cast("long").alias("only_b"),
                 F.coalesce(F.sum(F.least("ca", "cb")), F.lit(0)).cast("long").alias("common"))


def itemset_table(itemsets: DataFrame) -> DataFrame:
    """Text (sorted, ', '), size, count, support; size asc, support desc."""
    return itemsets.select(F.array_join(F.array_sort("items"), ", ").alias("itemset"),
                           F.col("k").cast("long").alias("size"),
                           F.col("freq").cast("long").alias("count"),
                           r6(F.col("support")).alias("support")).orderBy(
        "size", F.desc("support"), "itemset")
