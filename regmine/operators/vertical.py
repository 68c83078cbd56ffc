"""Vertical Apriori on bitmaps (I8).

Baskets are numbered; a block is ``64 * WORDS`` consecutive numbers.  The table of
bitmaps has, per block and frequent item, ``WORDS`` 64-bit columns with a bit for
every basket that holds the item, built in one scan by ``bit_or`` aggregates
(combined map-side, as a block lies in one input partition).  The support of a
candidate is the bit count of the AND of its items' columns, added up over the
blocks: fixed columns, so the whole pipeline is generated code.

Candidates are counted by prefix class: the AND of a prefix is formed once per
block and shared by all candidates that extend it.  Joins are on (block, item),
evenly spread however frequent an item is.  (Blocks without a bit left are not
filtered out on the way: a predicate over so many derived columns makes the
optimizer's constraint inference grow exponentially.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regmine.operators.itemsets import (Codes, MiningResult, explode_items, frequent_codes, level_wise,
                                        prefixes)
from regmine.session import materialize

WORDS = 8                    # 64-bit columns of a bitmap row
_W = [f"w{j}" for j in range(WORDS)]


def bitmaps(tx: DataFrame, codes: Codes) -> DataFrame:
    """(block, code, w0 .. w7): the bits of one item in one block of baskets."""
    numbered = codes.encoded(tx.select("items", F.monotonically_increasing_id().alias("__n")), "__n")
    rows = explode_items(numbered, "items", "code", "__n")
    at = F.col("__n") % (64 * WORDS)
    one = F.expr("shiftleft(1L, cast(__bit as int))")
    rows = rows.select(F.floor(F.col("__n") / (64 * WORDS)).alias("block"), "code",
                       F.floor(at / 64).alias("__word"), (at % 64).alias("__bit"))
    return rows.groupBy("block", "code").agg(*[
        F.bit_or(F.when(F.col("__word") == j, one).otherwise(F.lit(0).cast("bigint"))).alias(w)
        for j, w in enumerate(_W)])


def _and(a: str, b: str) -> list[Column]:
    return [F.col(f"{a}.{w}").bitwiseAND(F.col(f"{b}.{w}")).alias(w) for w in _W]


def _bits() -> Column:
    return F.expr(" + ".join(f"bit_count({w})" for w in _W)).cast("bigint")


def count_bitmaps(maps: DataFrame, cand: DataFrame | None, k: int, min_count: int,
                  n_cand: int = 0) -> DataFrame:
    """Support of the candidates (of all pairs when ``cand`` is None) as
    (k, items, freq) of those with freq >= min_count."""
    cur = maps.withColumnRenamed("code", "c1")
    allowed = prefixes(cand, k, n_cand) if cand is not None else None
    for j in range(2, k + 1):
        head = [f"c{i}" for i in range(1, j)]
        a = (cur if allowed is None else cur.join(allowed[j], head)).alias("a")
        b = maps.withColumnRenamed("code", f"b{j}").alias("b")
        match = F.col(f"b{j}") > F.col(f"a.c{j - 1}") if allowed is None else F.col(f"b{j}") == F.col(f"a.c{j}")
        last = F.col(f"b{j}").alias(f"c{j}")
        cur = (a.join(b, (F.col("a.block") == F.col("b.block")) & match)
               .select(F.col("a.block").alias("block"), *[F.col(f"a.{c}").alias(c) for c in head], last,
                       *_and("a", "b")))
    names = [f"c{i}" for i in range(1, k + 1)]
    counted = cur.select(*names, _bits().alias("n")).groupBy(*names).agg(F.sum("n").alias("freq"))
    return counted.where(F.col("freq") >= min_count).select(F.lit(k).alias("k"), F.array(*names).alias("items"), "freq")


def apriori_bitmaps(tx: DataFrame, min_support: float = 0.02, max_k: int | None = 3) -> MiningResult:
    """I8: level-wise Apriori whose supports are bit counts of vertical bitmaps."""
    tx, codes, n, min_count = frequent_codes(tx, min_support)
    maps = materialize(bitmaps(tx, codes)) if max_k is None or max_k > 1 else None
    return level_wise(codes, n, min_count, max_k, lambda cand, k, m: count_bitmaps(maps, cand, k, min_count, m))
