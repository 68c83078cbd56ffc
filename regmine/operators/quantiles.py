"""Order statistics on the range-partitioned value table.

A measure is read once into ``(value, count)`` rows, one per distinct value, by a
partially aggregated shuffle.  Range partitions with prefix offsets then give each
value the number of records before it, and a quantile is the value whose records
cover its rank: no task ever holds a buffer of all distinct values, even when
there are as many of them as rows.  Count, mean, variance and extremes come from
the same table, so nothing reads the source a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regmine.functions.numeric import broadcast_checked, scalars
from regmine.operators.concentration import running_sums
from regmine.session import materialize


def ranked_values(df: DataFrame, col: str | Column, by: list[str] | None = None) -> DataFrame:
    """(by.., v, c, a, n, mean): every distinct non-null value, its records, the
    records before it, all records and their mean (the last three per group)."""
    by = by or []
    x = F.col(col) if isinstance(col, str) else col
    vc = materialize(df.select(*by, x.cast("double").alias("v")).where(F.col("v").isNotNull())
                     .groupBy(*by, "v").agg(F.count(F.lit(1)).alias("c")))
    mean = F.sum(F.col("v") * F.col("c")) / F.sum("c")
    ranked = running_sums(vc, [*by, "v"], ["c"]).withColumn("a", F.col("cum_c") - F.col("c")).drop("cum_c")
    if not by:
        t = scalars(vc.agg(F.sum("c").alias("n"), mean.alias("mean")))
        return ranked.withColumns(t)
    # one row per group; records of the groups before it come off the rank
    per = ranked.groupBy(*by).agg(F.sum("c").alias("n"), mean.alias("mean"), F.min("a").alias("__first"))
    per = per.select(*[F.col(b).alias(f"__{b}") for b in by], "n", "mean", "__first")
    same = [F.col(b).eqNullSafe(F.col(f"__{b}")) for b in by]
    return ranked.join(broadcast_checked(per), same).select(
        *by, "v", "c", (F.col("a") - F.col("__first")).alias("a"), "n", "mean")


def quantile(p: float) -> Column:
    """Aggregate over ``ranked_values``: the p-quantile, interpolated linearly
    between the two records around its rank."""
    at = F.lit(float(p)) * (F.col("n") - 1)
    holds = lambda r: F.max(F.when((F.col("a") <= r) & (r < F.col("a") + F.col("c")), F.col("v")))
    low, high, rank = holds(F.floor(at)), holds(F.ceil(at)), F.max(at)
    return F.when(low == high, low).otherwise((F.ceil(rank) - rank) * low + (rank - F.floor(rank)) * high)


def summary(values: DataFrame, by: list[str] | None = None, **quantiles: float) -> DataFrame:
    """Per group: n, mean, mn, mx, var, std (sample) and the named quantiles."""
    d = F.col("v") - F.col("mean")
    squares = F.sum(F.col("c") * d * d)
    n = F.coalesce(F.max("n"), F.lit(0).cast("bigint"))
    var = F.when(n > 1, squares / (n - 1))
    return values.groupBy(*(by or [])).agg(
        n.alias("n"), F.max("mean").alias("mean"), F.min("v").alias("mn"), F.max("v").alias("mx"),
        var.alias("var"), F.sqrt(var).alias("std"), *[quantile(p).alias(name) for name, p in quantiles.items()])
