"""Concentration (G17-G19) on the value->count table.

A measure is first compressed to ``(v, c)`` with one partially aggregated
shuffle; every ordered quantity (records before a value, running sums) is then
computed on that table, whose size is bounded by the number of distinct values
(days of delay: a few tens of thousands at most), not by the row count.
Closed forms, with N records, S = sum, a = records before value v:

* discrete R = 1 - 2 * sum_v v*(c*N - (c*a + c(c+1)/2)) / ((N-1)*S)
* trapezoid R = 1 - (2/N) * ( sum_v v*(c*(N+1) - (c*a + c(c+1)/2)) / S - (x_min/S + 1)/2 )
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regmine.functions.numeric import scalars, r6, try_ratio


def running_sums(table: DataFrame, order, cols: list[str]) -> DataFrame:
    """Inclusive running sums ``cum_<c>`` of ``cols`` in ``order`` (a column
    name or list of names forming a unique key).

    Range-partition on the key (written, so the partition of each row is
    fixed), per-partition totals (one row per partition), their exclusive
    prefix sums broadcast back as offsets, and a window inside each range
    partition -- no single task ever holds more than one range."""
    from regmine.session import materialize
    order = [order] if isinstance(order, str) else list(order)
    ranged = materialize(table.repartitionByRange(*order).withColumn("__pid", F.spark_partition_id()))
    tot = ranged.groupBy("__pid").agg(*[F.sum(c).alias(f"__t_{c}") for c in cols])
    wp = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("__pid", *[F.coalesce(F.sum(f"__t_{c}").over(wp), F.lit(0)).alias(f"__o_{c}")
                                 for c in cols])
    wi = Window.partitionBy("__pid").orderBy(*order).rowsBetween(Window.unboundedPreceding,
                                                                  Window.currentRow)
    j = ranged.join(F.broadcast(offs), "__pid")
    return j.select(*table.columns, *[(F.sum(c).over(wi) + F.col(f"__o_{c}")).alias(f"cum_{c}")
                                      for c in cols])


def value_counts_table(df: DataFrame, col: str) -> DataFrame:
    """(v, c, a, cum_sum): counts per distinct value, records strictly before
    v and the running total of the measure up to and including v."""
    from regmine.session import materialize as _checkpoint
    x = F.col(col)
    # the compressed table is the one pass over the source; everything else
    # (size check, totals, running sums) reads its checkpoint
    vc = _checkpoint(df.where(x.isNotNull()).groupBy(x.cast("double").alias("v")).agg(
        F.count(F.lit(1)).alias("c")).withColumn("vc", F.col("v") * F.col("c")))
    rs = running_sums(vc, "v", ["c", "vc"])
    return rs.select("v", "c", (F.col("cum_c") - F.col("c")).alias("a"),
                     F.col("cum_vc").alias("cum_sum"))


def _sums(vct: DataFrame) -> DataFrame:
    # doubles before any product: counts of 1e10 and more would overflow 64 bits
    c, a = F.col("c").cast("double"), F.col("a").cast("double")
    n_before = c * a + c * (c + 1) / 2.0
    return vct.agg(F.sum("c").cast("double").alias("N"),
                   F.sum(F.col("v") * F.col("c")).alias("S"), F.min("v").alias("xmin"),
                   F.sum(F.col("v") * (c * F.col("__n") - n_before)).alias("T0"),
                   F.sum(F.col("v") * (c * (F.col("__n") + 1) - n_before)).alias("T1"))


def _with_n(vct: DataFrame) -> DataFrame:
    return vct.withColumn("__n", scalars(vct.agg(F.sum("c").cast("double").alias("n")))["n"])


def concentration_index(df: DataFrame, col: str) -> DataFrame:
    """Discrete concentration index R; null when N < 2 or S = 0."""
    s = _sums(_with_n(value_counts_table(df, col)))
    r = F.when((F.col("N") >= 2) & (F.col("S") != 0),
               F.lit(1.0) - 2.0 * F.col("T0") / ((F.col("N") - 1) * F.col("S")))
    return s.select(F.lit(col).alias("variable"), F.col("N").cast("long").alias("n"),
                    r6(r).alias("r"))


def concentration_trapezoid(df: DataFrame, col: str) -> DataFrame:
    """1 - 2 * trapezoid area under the Lorenz points (no origin added)."""
    s = _sums(_with_n(value_counts_table(df, col)))
    n, S = F.col("N"), F.col("S")
    area = (F.col("T1") / S - (F.col("xmin") / S + 1) / 2.0) / n
    r = F.when((n >= 2) & (S != 0), F.lit(1.0) - 2.0 * area)
    return s.select(F.lit(col).alias("variable"), n.cast("long").alias("n"), r6(r).alias("r"))


def lorenz_curve(df: DataFrame, col: str) -> DataFrame:
    """Lorenz points (F, Q) at the end of each distinct value, plus the
    origin; the polyline through them equals the per-record polyline."""
    vct = value_counts_table(df, col)
    tot = scalars(vct.agg(F.sum("c").cast("double").alias("N"),
                          F.sum(F.col("v") * F.col("c")).alias("S")))
    pts = vct.select(r6(try_ratio(F.col("a") + F.col("c"), tot["N"])).alias("f"),
                     r6(try_ratio(F.col("cum_sum"), tot["S"])).alias("q"))
    origin = vct.sparkSession.range(1).select(F.lit(0.0).alias("f"), F.lit(0.0).alias("q"))
    return origin.unionByName(pts)
