"""Correlation (H1-H3, H5, K1, K7).

Pearson is computed pairwise-complete from sums in one aggregate and divided
with ``try_divide`` so that a constant column yields null instead of raising.
Flag-vs-category correlations use closed forms over a single ``groupBy`` of
the category, so they work for any cardinality without a wide dummy table.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regmine.functions.numeric import scalars, r6


def dummies(df: DataFrame, col: str, prefix: str | None = None,
            values: list[str] | None = None) -> DataFrame:
    """H1: one 0/1 column per listed value; null -> all zeros.  Without
    ``values`` all distinct values are listed (a wide table has a column for
    each by definition; ``dummy_items`` is the sparse form for any number)."""
    prefix = prefix or col
    if values is None:
        values = sorted(r[0] for r in df.where(F.col(col).isNotNull()).select(col).distinct().collect())
    return df.select("*", *[F.coalesce((F.col(col) == v).cast("int"), F.lit(0)).alias(f"{prefix}_{v}")
                            for v in values])


def dummy_items(df: DataFrame, id_col: str, col: str, prefix: str | None = None) -> DataFrame:
    """H1 (sparse): one (id, dummy) row per non-null value, whatever the number
    of distinct values."""
    return df.where(F.col(col).isNotNull()).select(
        id_col, F.concat(F.lit(f"{prefix or col}_"), F.col(col).cast("string")).alias("dummy"))


def _pearson(x: Column, y: Column) -> list[Column]:
    """n, sample covariance and the two sample std devs over rows where both
    values are present (numerically stable built-in moment aggregates)."""
    both = x.isNotNull() & y.isNotNull()
    xx, yy = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return [F.count(xx), F.covar_samp(xx, yy), F.stddev_samp(xx), F.stddev_samp(yy)]


def _r_from(cov: Column, sx: Column, sy: Column) -> Column:
    return F.try_divide(cov, sx * sy)


def pearson_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """H2: long table (var_a, var_b, n, r) for every unordered pair, including
    the diagonal; pairwise deletion of nulls; constant column -> null."""
    pairs = [(a, a) for a in cols] + list(combinations(cols, 2))
    aggs = []
    for i, (a, b) in enumerate(pairs):
        aggs += [e.alias(f"p{i}_{j}") for j, e in enumerate(_pearson(F.col(a), F.col(b)))]
    one = df.agg(*aggs)
    rows = []
    for i, (a, b) in enumerate(pairs):
        cov, sx, sy = [F.col(f"p{i}_{j}") for j in (1, 2, 3)]
        rows.append(F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"),
                             F.col(f"p{i}_0").cast("long").alias("n"),
                             _r_from(cov, sx, sy).alias("r")))
    return one.select(F.inline(F.array(*rows))).select("var_a", "var_b", "n", r6(F.col("r")).alias("r"))


def correlation_strength(df: DataFrame, col: str = "r") -> DataFrame:
    """H5: |r| < 0.30 weak, < 0.50 moderate, otherwise strong."""
    a = F.abs(F.col(col))
    return df.withColumn("strength", F.when(F.col(col).isNull(), F.lit(None).cast("string"))
                         .when(a < 0.30, F.lit("debil")).when(a < 0.50, F.lit("moderada"))
                         .otherwise(F.lit("fuerte")))


def flag_category_correlation(df: DataFrame, flag: str, col: str) -> DataFrame:
    """H3: Pearson (phi) between a 0/1 flag and each category indicator,
    r = (N*n11 - n_o*n_c) / sqrt(n_o(N-n_o) * n_c(N-n_c)); descending.
    A null category is an all-zero indicator row, as with dummy columns."""
    from regmine.session import materialize as _checkpoint
    # one pass: per-category counts (null category kept for the totals)
    allg = _checkpoint(df.groupBy(F.col(col).alias("category"))
                       .agg(F.count(F.lit(1)).cast("double").alias("no"),
                            F.sum(F.col(flag)).cast("double").alias("n11")))
    tot = scalars(allg.agg(F.sum("no").alias("N"), F.sum("n11").alias("nc")))
    g = allg.where(F.col("category").isNotNull())
    N, nc = tot["N"], tot["nc"]
    r = F.try_divide(N * F.col("n11") - F.col("no") * nc,
                     F.sqrt(F.col("no") * (N - F.col("no")) * nc * (N - nc)))
    return g.select("category", F.col("no").cast("long").alias("n"), r6(r).alias("r")).orderBy(
        F.desc_nulls_last("r"), "category")


def numeric_category_correlation(df: DataFrame, num: str, col: str) -> DataFrame:
    """K7: point-biserial r between a numeric column and each category
    indicator, over rows where the number is present."""
    from regmine.session import materialize as _checkpoint
    x = F.col(num).cast("double")
    base = df.where(x.isNotNull())
    # one pass: per-category n, mean and variance (null category kept for the
    # totals); centred quantities, so a large mean does not cancel
    allg = _checkpoint(base.groupBy(F.col(col).alias("category"))
                       .agg(F.count(F.lit(1)).cast("double").alias("no"), F.avg(x).alias("mo"),
                            F.var_pop(x).alias("vo")))
    mean = scalars(allg.agg(F.sum("no").alias("N"), (F.sum(F.col("no") * F.col("mo")) / F.sum("no")).alias("m")))
    N, m = mean["N"], mean["m"]
    between = (F.col("mo") - m) * (F.col("mo") - m)
    sd = scalars(allg.agg(F.sqrt(F.sum(F.col("no") * (F.col("vo") + between)) / F.sum("no")).alias("sd")))["sd"]
    g = allg.where(F.col("category").isNotNull())
    r = F.try_divide((F.col("mo") - m) * F.sqrt(F.try_divide(F.col("no"), N - F.col("no"))), sd)
    return g.select("category", F.col("no").cast("long").alias("n"), r6(r).alias("r")).orderBy(
        F.desc_nulls_last("r"), "category")


def spearman_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """K1: Spearman = Pearson of average ranks (ties share the mean rank),
    ranked within each pair's complete rows (pairwise deletion).

    One pass over the data: every row emits one (pair, a, b) triple per pair,
    counted with a partially aggregated groupBy into the joint value table
    (bounded by distinct_a x distinct_b per pair).  Ranks come from running
    sums over each pair's marginal value counts, and the correlation is a
    count-weighted sum over the joint table; average ranks have mean (n+1)/2
    exactly, so the centred sums need no second pass."""
    from regmine.session import materialize as _checkpoint
    pairs = [(a, a) for a in cols] + list(combinations(cols, 2))
    trip = F.array(*[F.struct(F.lit(i).alias("p"), F.col(a).cast("double").alias("va"),
                              F.col(b).cast("double").alias("vb")) for i, (a, b) in enumerate(pairs)])
    stacked = df.select(F.inline_outer(trip))
    joint = _checkpoint(stacked.where(F.col("va").isNotNull() & F.col("vb").isNotNull())
                        .groupBy("p", "va", "vb").agg(F.count(F.lit(1)).alias("c")))

    from regmine.operators.concentration import running_sums

    def ranks(side: str, out: str) -> DataFrame:
        # running count over (pair, value) minus the counts of earlier pairs
        m = joint.groupBy("p", side).agg(F.sum("c").alias("__m"))
        rs = running_sums(m, ["p", side], ["__m"])
        per = m.groupBy("p").agg(F.sum("__m").alias("__pt"))
        wp = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)  # one row per pair
        start = per.select("p", F.coalesce(F.sum("__pt").over(wp), F.lit(0)).alias("__start"))
        return rs.join(F.broadcast(start), "p").select(
            "p", side, (F.col("cum___m") - F.col("__start") - F.col("__m") + (F.col("__m") + 1) / 2.0)
            .alias(out))

    n = joint.groupBy("p").agg(F.sum("c").alias("n"))
    j = joint.join(ranks("va", "ra"), ["p", "va"]).join(ranks("vb", "rb"), ["p", "vb"])\
        .join(F.broadcast(n), "p")  # one row per pair of columns
    mid = (F.col("n") + 1) / 2.0
    da, db = F.col("ra") - mid, F.col("rb") - mid
    agg = j.groupBy("p").agg(F.first("n").alias("n"), F.sum(F.col("c") * da * db).alias("sab"),
                             F.sum(F.col("c") * da * da).alias("saa"),
                             F.sum(F.col("c") * db * db).alias("sbb"))
    names = F.array(*[F.struct(F.lit(i).alias("p"), F.lit(a).alias("var_a"), F.lit(b).alias("var_b"))
                      for i, (a, b) in enumerate(pairs)])
    label = df.sparkSession.range(1).select(F.inline(names))
    r = F.when(F.col("n") >= 2, F.try_divide(F.col("sab"), F.sqrt(F.col("saa") * F.col("sbb"))))
    out = label.join(agg, "p", "left").select(
        "var_a", "var_b", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"), r6(r).alias("r"))
    return out
