"""Derived features (F1-F11): ages, delays, bands, items, sentinel filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regmine import schema as S
from regmine.functions.bands import age_band_expr, month_item_expr, term_band_expr, year_item_expr
from regmine.functions.dates import floor_days_between
from regmine.functions.numeric import scalars, clamp_null
from regmine.functions.text import not_equal_null_safe

BIRTH_DT, DIS_DT, REG_DT = S.BIRTH + "_DT", S.DISAPPEARED + "_DT", S.REGISTERED + "_DT"


def age_years_diff(df: DataFrame, lo: int | None = 0, hi: int | None = 110,
                   out: str = "EDAD", birth: str = BIRTH_DT, event: str = DIS_DT) -> DataFrame:
    """calendar-year difference; null outside [lo, hi] unless both are None."""
    age = (F.year(event) - F.year(birth)).cast("long")
    age = clamp_null(age, F.lit(lo - 1).cast("long") if lo is not None else None,
                     F.lit(hi + 1).cast("long") if hi is not None else None)
    return df.withColumn(out, age)


def delay_days(df: DataFrame, out: str = "DIAS_REGISTRO", keep_negative: bool = False,
               start: str = DIS_DT, end: str = REG_DT) -> DataFrame:
    """registration delay in floored whole days; negatives nulled by default."""
    d = floor_days_between(F.col(start), F.col(end))
    return df.withColumn(out, d if keep_negative else clamp_null(d, F.lit(-1).cast("long")))


def age_fractional(df: DataFrame, out: str = "EDAD_FRAC", lo: float = 0, hi: float = 120,
                   birth: str = BIRTH_DT, event: str = DIS_DT) -> DataFrame:
    """floored days / 365.25, null outside [lo, hi]."""
    # lo <= days / 365.25 <= hi  <=>  ceil(lo*365.25) <= days <= floor(hi*365.25)
    import math
    d = clamp_null(floor_days_between(F.col(birth), F.col(event)),
                   F.lit(math.ceil(lo * 365.25) - 1).cast("long"),
                   F.lit(math.floor(hi * 365.25) + 1).cast("long"))
    return df.withColumn(out, d / F.lit(365.25))


def _median_scalar(df: DataFrame, col: str):
    """Exact median of a column, from its range-partitioned value table."""
    from regmine.operators.quantiles import ranked_values, summary
    return scalars(summary(ranked_values(df, col), median=0.5).select("median"))["median"]


def age_floor_imputed(df: DataFrame, out: str = "EDAD", birth: str = BIRTH_DT,
                      event: str = DIS_DT) -> DataFrame:
    """floor(days / 365) with nulls filled by the column median."""
    raw = df.withColumn("__age", F.floor(floor_days_between(F.col(birth), F.col(event))
                                         / F.lit(365)).cast("double"))
    med = _median_scalar(raw, "__age")
    return raw.withColumn(out, F.coalesce(F.col("__age"), med)).drop("__age")


def delay_imputed(df: DataFrame, out: str = "RETRASO_REGISTRO", start: str = DIS_DT,
                  end: str = REG_DT) -> DataFrame:
    """floored delay (negatives kept) with nulls filled by the median."""
    raw = df.withColumn("__d", floor_days_between(F.col(start), F.col(end)).cast("double"))
    med = _median_scalar(raw, "__d")
    return raw.withColumn(out, F.coalesce(F.col("__d"), med)).drop("__d")


def age_band(df: DataFrame, age: str = "EDAD_FRAC", out: str = "GRUPO_EDAD") -> DataFrame:
    """right-closed age bands, null -> DESCONOCIDO."""
    return df.withColumn(out, age_band_expr(F.col(age)))


def term_band(df: DataFrame, col: str, out: str, edges=None, labels=None) -> DataFrame:
    """left-closed six-year terms, outside -> DESCONOCIDO."""
    return df.withColumn(out, term_band_expr(F.col(col), edges, labels))


def month_item(df: DataFrame, col: str = DIS_DT, out: str = "MES_DESAPARICION") -> DataFrame:
    """F8: two-digit month text, null -> DESCONOCIDO."""
    return df.withColumn(out, month_item_expr(F.col(col)))


def year_item(df: DataFrame, col: str, out: str) -> DataFrame:
    """year text, null -> DESCONOCIDO."""
    return df.withColumn(out, year_item_expr(F.col(col)))


def delay_scales(df: DataFrame, col: str = "DIAS_REGISTRO") -> DataFrame:
    """delay in months (/30) and years (/365)."""
    return df.withColumns({"MESES_REGISTRO": F.col(col) / F.lit(30.0),
                           "ANIOS_REGISTRO": F.col(col) / F.lit(365.0)})


def exclude_sentinel(df: DataFrame, cols: list[str] | None = None,
                     include: bool = False, sentinel: str = S.WITHHELD) -> DataFrame:
    """drop rows where any column equals the sentinel (nulls kept)."""
    if include:
        return df
    cols = cols or [S.SEX, S.STATUS, S.MUNI]
    cond = F.lit(True)
    for c in cols:
        cond = cond & not_equal_null_safe(F.col(c), sentinel)
    return df.where(cond)


def mining_table(raw: DataFrame, include_withheld: bool = False,
                 years: bool = False) -> DataFrame:
    """Raw text registry -> item columns for association mining and the
    classifier (sentinel filter, parse, terms / years, month, age band)."""
    from regmine.operators.clean import parse_dates_any
    df = exclude_sentinel(raw, include=include_withheld)
    df = parse_dates_any(df, {S.DISAPPEARED: [S.TIMESTAMP_FORMAT],
                              S.REGISTERED: [S.TIMESTAMP_FORMAT],
                              S.BIRTH: [S.DATE_FORMAT]})
    if years:
        df = year_item(df, DIS_DT, "ANIO_DESAPARICION")
        df = year_item(df, REG_DT, "ANIO_REGISTRO")
    else:
        df = term_band(df, DIS_DT, "SEXENIO_DESAPARICION")
        df = term_band(df, REG_DT, "SEXENIO_REGISTRO")
    df = month_item(df)
    df = age_fractional(df)
    return age_band(df)
