"""Descriptive statistics.

Totals reach row-level expressions as literals from one-row aggregates
(never an unpartitioned window).  Ordered statistics, and the totals that go with
them, come from the range-partitioned value table (``operators.quantiles``), which
is the only pass over the source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regmine.functions.numeric import broadcast_checked, scalars, r6, try_ratio
from regmine.operators.quantiles import ranked_values, summary


def mode_table(df: DataFrame, cols: list[str], denom: int | None = None) -> DataFrame:
    """G1: most frequent non-null value per column (ties -> smallest value),
    its count, and percent of ``denom`` (default: the input's row count).

    One stacked ``groupBy(variable, value)`` with map-side combine, written; nulls
    are groups of it too, so every column's groups add up to the row count."""
    from regmine.session import materialize
    stacked = df.select(F.inline_outer(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value"))
        for c in cols])))
    counts = materialize(stacked.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n")))
    best = counts.where(F.col("value").isNotNull()).groupBy("variable").agg(
        F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value"))).alias("b"))
    total = F.lit(denom) if denom is not None else scalars(
        counts.where(F.col("variable") == cols[0]).agg(F.sum("n").alias("n")))["n"]
    return best.select("variable", F.col("b.value").alias("mode"),
                       (-F.col("b.neg")).cast("long").alias("count"),
                       r6(try_ratio(-F.col("b.neg") * 100, total)).alias("pct"))


def location_stats(df: DataFrame, col: str) -> DataFrame:
    """N, mean and median of a numeric column (nulls skipped)."""
    return summary(ranked_values(df, col), median=0.5).select(
        F.lit(col).alias("variable"), "n", r6(F.col("mean")).alias("mean"), r6(F.col("median")).alias("median"))


def delay_summary(df: DataFrame, col: str = "DIAS_REGISTRO") -> DataFrame:
    """N, median, mean, max days, max years, share registered the same day."""
    values = ranked_values(df, col)
    same_day = scalars(values.agg(F.coalesce(F.sum(F.when(F.col("v") == 0, F.col("c"))), F.lit(0)).alias("s")))["s"]
    return summary(values, median=0.5).select(
        "n", r6(F.col("median")).alias("median"), r6(F.col("mean")).alias("mean"),
        F.col("mx").cast("long").alias("max_days"), r6(F.col("mx") / F.lit(365.0)).alias("max_years"),
        r6(try_ratio(same_day, F.col("n"))).alias("same_day_share"))


def spread_stats(df: DataFrame, col: str) -> DataFrame:
    """G4 + G5: range, quartiles (linear interpolation), IQR, sample var / std."""
    a = summary(ranked_values(df, col), q1=0.25, q3=0.75)
    return a.select(F.lit(col).alias("variable"), r6(F.col("mx") - F.col("mn")).alias("range"),
                    r6(F.col("q1")).alias("q1"), r6(F.col("q3")).alias("q3"),
                    r6(F.col("q3") - F.col("q1")).alias("iqr"),
                    r6(F.col("var")).alias("variance"), r6(F.col("std")).alias("std"))


def compare_spread(frames: dict[str, DataFrame], col: str) -> DataFrame:
    """The spread report for several datasets from one value table; a
    dataset without values reports n = 0."""
    names = list(frames)
    u = frames[names[0]].select(F.lit(names[0]).alias("dataset"), F.col(col).alias("x"))
    for n in names[1:]:
        u = u.unionByName(frames[n].select(F.lit(n).alias("dataset"), F.col(col).alias("x")))
    a = summary(ranked_values(u, "x", ["dataset"]), ["dataset"], q1=0.25, q3=0.75)
    return a.select("dataset", "n", r6(F.col("mx") - F.col("mn")).alias("range"),
                    r6(F.col("q3") - F.col("q1")).alias("iqr"),
                    r6(F.col("var")).alias("variance"), r6(F.col("std")).alias("std"))


def box_stats(df: DataFrame, col: str, by: str | None = None) -> DataFrame:
    """Quartiles, 1.5 IQR fences, whiskers (most extreme points inside the
    fences), mean and outlier count; per group when ``by`` is given.  Fences
    (one row per group) meet the value table again, never the source."""
    keys = [by] if by else []
    values = ranked_values(df, col, keys)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    p = summary(values, keys, q1=0.25, median=0.5, q3=0.75).select(
        *keys, "q1", "median", "q3", F.col("mean").alias("m"), (F.col("q1") - reach).alias("lo_fence"),
        (F.col("q3") + reach).alias("hi_fence"))
    if by:
        p = p.withColumnRenamed(by, "__by")
        j = values.join(broadcast_checked(p), F.col(by).eqNullSafe(F.col("__by")))
    else:
        j = values.withColumns(scalars(p))
    v, c = F.col("v"), F.col("c")
    inside = (v >= F.col("lo_fence")) & (v <= F.col("hi_fence"))
    known = [r6(F.max(x)).alias(x) for x in ("q1", "median", "q3")]
    out = j.groupBy(*keys).agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"), *known,
        r6(F.max("q3") - F.max("q1")).alias("iqr"), r6(F.max("lo_fence")).alias("lo_fence"),
        r6(F.max("hi_fence")).alias("hi_fence"), r6(F.min(F.when(inside, v))).alias("whisker_low"),
        r6(F.max(F.when(inside, v))).alias("whisker_high"), r6(F.max("m")).alias("mean"),
        F.coalesce(F.sum(F.when(~inside, c)), F.lit(0)).alias("outliers"))
    return out


def histogram(df: DataFrame, col: str, bins: int = 60, density: bool = False,
              cap: float | None = None) -> DataFrame:
    """Equal-width bins over [min, max] (last bin closed), counts and density.
    Only non-empty bins are emitted.  The value -> count table is the one pass
    over the source."""
    from regmine.session import materialize
    x = F.col(col).cast("double")
    base = df.select(x.alias("v")).where(F.col("v").isNotNull())
    if cap is not None:
        base = base.where(F.col("v") <= cap)
    vc = materialize(base.groupBy("v").agg(F.count(F.lit(1)).alias("c")))
    rng = scalars(vc.agg(F.min("v").alias("mn"), F.max("v").alias("mx"), F.sum("c").alias("n")))
    width = (rng["mx"] - rng["mn"]) / F.lit(float(bins))
    idx = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("v") - rng["mn"]) / width), F.lit(bins - 1))).cast("long")
    h = vc.groupBy(idx.alias("bin")).agg(F.sum("c").alias("count"))
    dens = try_ratio(F.col("count"), rng["n"] * F.when(width == 0, F.lit(1.0)).otherwise(width))
    return h.select("bin", r6(rng["mn"] + F.col("bin") * width).alias("lo"),
                    r6(rng["mn"] + (F.col("bin") + 1) * width).alias("hi"),
                    "count", r6(dens).alias("density"))


def kde(df: DataFrame, col: str, grid: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on an even grid, Scott bandwidth
    ``std * n^(-1/5)``, grid from min - cut*bw to max + cut*bw.

    Works on the value->count table (compressed measure) and expands each
    distinct value over the grid with a generator, then sums per grid point."""
    from regmine.session import materialize as _checkpoint
    x = F.col(col).cast("double")
    # one pass over the source into the value->count table; n, mean, sample
    # std, min and max come from it (two small passes over the checkpoint)
    vc = _checkpoint(df.where(x.isNotNull()).groupBy(x.alias("v")).agg(F.count(F.lit(1)).alias("c")))
    m1 = scalars(vc.agg(F.sum("c").alias("n"), (F.sum(F.col("v") * F.col("c")) / F.sum("c")).alias("mean"),
                        F.min("v").alias("mn"), F.max("v").alias("mx")))
    var = vc.agg((F.sum(F.col("c") * (F.col("v") - m1["mean"]) * (F.col("v") - m1["mean"]))
                  / (F.sum("c") - 1)).alias("var"))
    st = dict(m1, sd=scalars(var.select(F.sqrt(F.when(F.col("var") >= 0, F.col("var"))).alias("sd")))["sd"])
    bw = st["sd"] * F.pow(st["n"].cast("double"), F.lit(-0.2))
    lo = st["mn"] - F.lit(cut) * bw
    step = (st["mx"] - st["mn"] + F.lit(2 * cut) * bw) / F.lit(float(grid - 1))
    g = vc.select("v", "c", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("g"))
    gx = lo + F.col("g") * step
    z = (gx - F.col("v")) / bw
    contrib = F.col("c") * F.exp(-0.5 * z * z)
    dens = g.groupBy("g").agg(F.sum(contrib).alias("s"))
    norm = st["n"] * bw * F.lit(math.sqrt(2 * math.pi))
    return dens.select(F.col("g").cast("long").alias("point"),
                       r6(lo + F.col("g") * step).alias("x"),
                       r6(try_ratio(F.col("s"), norm)).alias("density"))


def sigma_band(df: DataFrame, col: str) -> DataFrame:
    """Mean +- one sample std and the share of values inside the band, from
    the value -> count table (the one pass over the source)."""
    from regmine.session import materialize
    vc = materialize(df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
                     .groupBy("v").agg(F.count(F.lit(1)).alias("c")))
    mean = scalars(vc.agg((F.sum(F.col("v") * F.col("c")) / F.sum("c")).alias("m")))["m"]
    d = F.col("v") - mean
    n = F.coalesce(F.sum("c"), F.lit(0))
    std = scalars(vc.agg(F.sqrt(F.when(n > 1, F.sum(F.col("c") * d * d) / (n - 1))).alias("s")))["s"]
    lo, hi = mean - std, mean + std
    inside = F.coalesce(F.sum(F.when((F.col("v") >= lo) & (F.col("v") <= hi), F.col("c"))), F.lit(0))
    return vc.agg(n.alias("n"), inside.alias("inside")).select(
        "n", r6(mean).alias("mean"), r6(std).alias("std"), r6(lo).alias("low"),
        r6(hi).alias("high"), "inside", r6(try_ratio(F.col("inside"), F.col("n"))).alias("share"))


def category_share(df: DataFrame, col: str, exclude: list[str] | None = None) -> DataFrame:
    """Count and percent of each non-null category (sentinel classes are
    categories unless listed in ``exclude``).  One pass: the grouped table is
    checkpointed and the total comes from it."""
    vc = _proportions(df, col, exclude).withColumnRenamed("c", "count")
    total = scalars(vc.agg(F.sum("count").alias("t")))["t"]
    return vc.select("value", "count", r6(try_ratio(F.col("count") * 100, total)).alias("pct"))


def top_categories(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """Top-k categories by count (ties by value)."""
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "value").limit(k))


def _proportions(df: DataFrame, col: str, exclude: list[str] | None) -> DataFrame:
    """Category counts (nulls and excluded classes dropped), checkpointed: a
    table bounded by the number of categories, read by every later step."""
    from regmine.session import materialize as _checkpoint
    c = F.col(col)
    base = df.where(c.isNotNull())
    if exclude:
        base = base.where(~c.isin(*exclude))
    return _checkpoint(base.groupBy(c.alias("value")).agg(F.count(F.lit(1)).alias("c")))


def diversity(df: DataFrame, col: str, exclude: list[str] | None = None) -> DataFrame:
    """Gini impurity, Shannon entropy (bits) and Pielou evenness
    (0 when one category) from the category count table."""
    vc = _proportions(df, col, exclude)
    t = vc.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("k"),
               F.sum(F.col("c").cast("double") * F.col("c").cast("double")).alias("ss"),
               F.sum(F.col("c") * F.log2(F.col("c"))).alias("clc"))
    n = F.col("n").cast("double")
    h = F.log2(n) - F.col("clc") / n
    return t.select(F.lit(col).alias("variable"), F.col("k").cast("long").alias("categories"),
                    r6(F.lit(1.0) - F.col("ss") / (n * n)).alias("gini"),
                    r6(h).alias("entropy"),
                    r6(F.when(F.col("k") > 1, h / F.log2(F.col("k"))).otherwise(F.lit(0.0)))
                    .alias("evenness"))


def gini_impurity(df: DataFrame, col: str, exclude=None) -> DataFrame:
    return diversity(df, col, exclude).select("variable", "gini")


def shannon_entropy(df: DataFrame, col: str, exclude=None) -> DataFrame:
    return diversity(df, col, exclude).select("variable", "entropy")


def pielou_evenness(df: DataFrame, col: str, exclude=None) -> DataFrame:
    return diversity(df, col, exclude).select("variable", "evenness")


def proportion_vs_uniform(df: DataFrame, col: str, exclude: list[str] | None = None) -> DataFrame:
    """Category proportion against the uniform share 1/k, over/under label."""
    vc = _proportions(df, col, exclude)
    t = scalars(vc.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("k")))
    p = F.col("c") / t["n"]
    u = F.lit(1.0) / t["k"]
    return vc.select("value", F.col("c").alias("count"), r6(p).alias("proportion"),
                     r6(u).alias("uniform"),
                     F.when(p > u, F.lit("SOBRE")).when(p < u, F.lit("BAJO"))
                     .otherwise(F.lit("IGUAL")).alias("position"))


def withheld_share_by(df: DataFrame, group: str, flag: str = "confidencial_total",
                      k: int = 15) -> DataFrame:
    """Withheld sum, count, percent (1 dp) per group; the k highest
    (ties by group), with the national mean percent alongside."""
    from regmine.session import materialize as _checkpoint
    g = _checkpoint(df.groupBy(group).agg(F.sum(flag).cast("long").alias("withheld"),
                                          F.count(F.lit(1)).alias("n")))
    # national mean from the same grouped table (all groups, the null group too)
    nat = scalars(g.agg((F.sum("withheld") * 100.0 / F.sum("n")).alias("p")))["p"]
    pct = F.round(F.col("withheld") * 100.0 / F.col("n"), 1)
    return (g.select(group, "withheld", "n", r6(pct).alias("pct"), r6(nat).alias("national_pct"))
            .orderBy(F.desc("pct"), F.asc(group)).limit(k))


def shape_stats(df: DataFrame, col: str) -> DataFrame:
    """K2: bias-corrected sample skewness and excess kurtosis (the population
    moments from ``skewness``/``kurtosis`` corrected explicitly)."""
    x = F.col(col)
    a = df.where(x.isNotNull()).agg(F.count(F.lit(1)).alias("n"),
                                    F.skewness(x).alias("g1"), F.kurtosis(x).alias("g2"))
    n = F.col("n").cast("double")
    skew = F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, ((n + 1) * F.col("g2") + 6) * (n - 1) / ((n - 2) * (n - 3)))
    return a.select(F.lit(col).alias("variable"), "n", r6(skew).alias("skewness"),
                    r6(kurt).alias("kurtosis"))
