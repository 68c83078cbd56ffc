"""Published-but-uncoded results (K3-K6, K8, K9) on the temporal product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regmine import schema as S
from regmine.functions.bands import term_band_expr
from regmine.functions.numeric import scalars, r6, try_ratio
from regmine.session import materialize

ANOMALY = "flag_registro_antes_desaparicion"
DIS_DT, REG_DT = S.DISAPPEARED + "_DT", S.REGISTERED + "_DT"


def _computable():
    return F.col(DIS_DT).isNotNull() & F.col(REG_DT).isNotNull()


def anomaly_concentration(df: DataFrame, k: int = 5, group: str = S.SOURCE) -> DataFrame:
    """K3: share of anomalies held by the k sources with most anomalies, and
    those sources' share of rows with computable dates."""
    g = materialize(df.where(_computable()).groupBy(group).agg(
        F.sum(ANOMALY).alias("a"), F.count(F.lit(1)).alias("c")))
    top = g.orderBy(F.desc("a"), group).limit(k)
    tot = scalars(g.agg(F.sum("a").alias("a"), F.sum("c").alias("c")))
    return top.agg(F.sum("a").alias("ta"), F.sum("c").alias("tc")).select(
        F.lit(k).cast("long").alias("k"), F.col("ta").cast("long").alias("anomalies"),
        r6(try_ratio(F.col("ta") * 100, tot["a"])).alias("anomaly_share"),
        r6(try_ratio(F.col("tc") * 100, tot["c"])).alias("row_share"))


def anomaly_buckets(df: DataFrame) -> DataFrame:
    """K4: how far registration precedes disappearance, in buckets."""
    secs = F.unix_timestamp(F.col(DIS_DT)) - F.unix_timestamp(F.col(REG_DT))
    day = 86400
    b = (F.when(secs <= day, F.lit("a) <= 1 dia"))
         .when(secs <= 7 * day, F.lit("b) 1-7 dias"))
         .when(secs <= 30 * day, F.lit("c) 7-30 dias"))
         .when(secs <= 365 * day, F.lit("d) 30-365 dias"))
         .otherwise(F.lit("e) > 1 anio")))
    return df.where(F.col(ANOMALY) == 1).groupBy(b.alias("bucket")).agg(
        F.count(F.lit(1)).alias("count"))


def anomaly_rate(df: DataFrame) -> DataFrame:
    """K5: anomalies over rows where both dates are present."""
    return df.agg(F.count_if(F.col(ANOMALY) == 1).alias("anomalies"),
                  F.count_if(_computable()).alias("computable")).select(
        "anomalies", "computable",
        r6(try_ratio(F.col("anomalies") * 100, F.col("computable"))).alias("pct"))


def records_by_term(df: DataFrame, col: str = DIS_DT) -> DataFrame:
    """K6: records per six-year term of the date."""
    return df.groupBy(term_band_expr(F.col(col)).alias("term")).agg(
        F.count(F.lit(1)).alias("count"))


def trend(df: DataFrame, grain: str = "year", col: str = DIS_DT) -> DataFrame:
    """K8: records per year or month of the date (null dates -> null period)."""
    fmt = "yyyy" if grain == "year" else "yyyy-MM"
    return df.groupBy(F.date_format(F.col(col), fmt).alias("period")).agg(
        F.count(F.lit(1)).alias("count"))


def source_by_state(df: DataFrame) -> DataFrame:
    """K9: reports per (institution, state)."""
    return df.groupBy(S.SOURCE, S.STATE).agg(F.count(F.lit(1)).alias("count"))
