"""Cleaning, validation and export products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regmine import schema as S
from regmine.functions.dates import safe_timestamp, safe_timestamp_any
from regmine.functions.numeric import safe_long
from regmine.functions.text import is_value, normalize_text

DT = "_DT"
GENERAL_COLUMNS = [
    S.ID, S.SOURCE, S.BIRTH, "FECHA_NACIMIENTO_LIMPIA", S.SEX, S.DISAPPEARED,
    "FECHA_DESAPARICION_LIMPIA", S.REGISTERED, "FECHA_REGISTRO_LIMPIA", S.STATUS,
    S.STATE_CODE, S.STATE, S.MUNI_CODE, S.MUNI, "confidencial_con_estado",
    "confidencial_sin_estado"]
TEMPORAL_COLUMNS = [
    S.ID, S.SOURCE, S.BIRTH, S.SEX, S.DISAPPEARED, S.REGISTERED, S.STATUS,
    S.STATE_CODE, S.STATE, S.MUNI_CODE, S.MUNI, "nulo_fecha_nacimiento",
    "nulo_fecha_desaparicion", "nulo_fecha_registro", "flag_nacimiento_invalido",
    "flag_nacimiento_despues_desaparicion", "flag_nacimiento_despues_registro",
    "flag_registro_antes_desaparicion"]
NULL_FLAGS = {"nulo_fecha_nacimiento": S.BIRTH, "nulo_fecha_desaparicion": S.DISAPPEARED,
              "nulo_fecha_registro": S.REGISTERED}
INVALID_FLAGS = {"flag_nacimiento_invalido": S.BIRTH,
                 "flag_desaparicion_invalido": S.DISAPPEARED,
                 "flag_registro_invalido": S.REGISTERED}
CHRONO_FLAGS = {
    "flag_nacimiento_despues_desaparicion": (S.BIRTH, ">", S.DISAPPEARED),
    "flag_nacimiento_despues_registro": (S.BIRTH, ">", S.REGISTERED),
    "flag_registro_antes_desaparicion": (S.REGISTERED, "<", S.DISAPPEARED),
}
DEFAULT_DATE_SPECS = {S.BIRTH: S.DATE_FORMAT, S.DISAPPEARED: S.TIMESTAMP_FORMAT,
                      S.REGISTERED: S.TIMESTAMP_FORMAT}


def to_nullable_long(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Text -> nullable integer ('9.0' -> 9, non-numeric -> null)."""
    cols = cols or S.CODE_COLUMNS
    return df.withColumns({c: safe_long(F.col(c)) for c in cols})


def to_text(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Force text type, nulls preserved."""
    cols = cols or S.TEXT_COLUMNS
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def normalize_categories(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Strip, collapse inner whitespace, upper-case."""
    cols = cols or S.CATEGORY_COLUMNS
    return df.withColumns({c: normalize_text(F.col(c)) for c in cols})


def normalization_report(before: DataFrame, after: DataFrame,
                         cols: list[str] | None = None) -> DataFrame:
    """Distinct count per column before and after normalisation."""
    cols = cols or S.CATEGORY_COLUMNS
    b = before.agg(*[F.count_distinct(c).alias(c) for c in cols]).unpivot(
        [], cols, "column", "before")
    a = after.agg(*[F.count_distinct(c).alias(c) for c in cols]).unpivot(
        [], cols, "column", "after")
    return b.join(a, "column").select("column", F.col("before").cast("long").alias("before"),
                                      F.col("after").cast("long").alias("after"))


def parse_dates(df: DataFrame, specs: dict[str, str] | None = None,
                min_ts: str | None = S.MIN_TS, max_ts: str | None = S.MAX_TS,
                suffix: str = DT) -> DataFrame:
    """Fixed-format parse into ``<col>_DT``; failures and out-of-range -> null."""
    specs = specs or DEFAULT_DATE_SPECS
    return df.withColumns({c + suffix: safe_timestamp(F.col(c), fmt, min_ts, max_ts)
                           for c, fmt in specs.items()})


def parse_dates_any(df: DataFrame, specs: dict[str, list[str]], suffix: str = DT,
                    min_ts: str | None = S.MIN_TS, max_ts: str | None = S.MAX_TS) -> DataFrame:
    """E5: parse with the first matching pattern of an explicit list."""
    return df.withColumns({c + suffix: safe_timestamp_any(F.col(c), fmts, min_ts, max_ts)
                           for c, fmts in specs.items()})


def temporal_subset(df: DataFrame, proxy: str = S.BIRTH) -> DataFrame:
    """The temporal product excludes the withheld block (null-safe)."""
    return df.where(~is_value(F.col(proxy), S.WITHHELD))


def null_date_flags(df: DataFrame) -> DataFrame:
    """0/1 flags for null date text."""
    return df.withColumns({f: F.col(c).isNull().cast("int") for f, c in NULL_FLAGS.items()})


def flag_sums(df: DataFrame, flags: list[str]) -> DataFrame:
    """Sums of 0/1 flag columns as one (flag, total) table."""
    agg = df.agg(*[F.sum(f).cast("long").alias(f) for f in flags])
    return agg.unpivot([], flags, "flag", "total").select(
        "flag", F.coalesce(F.col("total"), F.lit(0)).cast("long").alias("total"))


def code_label_mismatches(df: DataFrame, code_col: str = S.STATE_CODE, label_col: str = S.STATE,
                          code: int = S.UNKNOWN_STATE_CODE, label: str = S.UNKNOWN) -> DataFrame:
    """Rows where (code = 99) xor (label = unknown); a null code never counts."""
    c = F.col(code_col)
    lab = is_value(F.col(label_col), label)
    bad = ((c == code) & ~lab) | ((c != code) & lab)
    return df.agg(F.count_if(F.coalesce(bad, F.lit(False))).alias("mismatches"))


def invalid_date_flags(df: DataFrame, suffix: str = DT) -> DataFrame:
    """Text present but the parse failed."""
    return df.withColumns({f: (F.col(c).isNotNull() & F.col(c + suffix).isNull()).cast("int")
                           for f, c in INVALID_FLAGS.items()})


def invalid_date_rows(df: DataFrame, flag: str = "flag_nacimiento_invalido",
                      col: str = S.BIRTH) -> DataFrame:
    """The offending rows (id and original text)."""
    return df.where(F.col(flag) == 1).select(S.ID, col)


def chronology_flags(df: DataFrame, suffix: str = DT) -> DataFrame:
    """Impossible orderings between the parsed dates (both non-null)."""
    out = {}
    for f, (a, op, b) in CHRONO_FLAGS.items():
        x, y = F.col(a + suffix), F.col(b + suffix)
        cmp = (x > y) if op == ">" else (x < y)
        out[f] = F.coalesce(cmp, F.lit(False)).cast("int")
    return df.withColumns(out)


def serialize_dates(df: DataFrame, mode: str = "general", suffix: str = DT) -> DataFrame:
    """Dates back to text; 'general' adds *_LIMPIA, 'temporal' overwrites."""
    fmts = {S.BIRTH: "yyyy-MM-dd", S.DISAPPEARED: S.TIMESTAMP_OUT_FORMAT,
            S.REGISTERED: S.TIMESTAMP_OUT_FORMAT}
    if mode == "general":
        return df.withColumns({c + "_LIMPIA": F.date_format(F.col(c + suffix), f)
                               for c, f in fmts.items()})
    return df.withColumns({c: F.date_format(F.col(c + suffix), f) for c, f in fmts.items()})


def project_general(df: DataFrame) -> DataFrame:
    """16-column general product."""
    return df.select(*GENERAL_COLUMNS)


def project_temporal(df: DataFrame) -> DataFrame:
    """18-column temporal product."""
    return df.select(*TEMPORAL_COLUMNS)


def export_summary(general: DataFrame, temporal: DataFrame) -> DataFrame:
    """Rows, columns and key flag sums of both products (two aggregates)."""
    g = general.agg(F.count(F.lit(1)).alias("n_rows"),
                    F.sum("confidencial_con_estado").cast("long").alias("confidencial_con_estado"),
                    F.sum("confidencial_sin_estado").cast("long").alias("confidencial_sin_estado"))
    t = temporal.agg(F.count(F.lit(1)).alias("n_rows"),
                     F.sum("flag_nacimiento_invalido").cast("long").alias("flag_nacimiento_invalido"),
                     F.sum("flag_registro_antes_desaparicion").cast("long")
                     .alias("flag_registro_antes_desaparicion"))
    null = F.lit(None).cast("long")
    return g.select(F.lit("general").alias("product"), "n_rows",
                    F.lit(len(general.columns)).cast("long").alias("n_columns"),
                    "confidencial_con_estado", "confidencial_sin_estado",
                    null.alias("flag_nacimiento_invalido"),
                    null.alias("flag_registro_antes_desaparicion")).unionByName(
        t.select(F.lit("temporal").alias("product"), "n_rows",
                 F.lit(len(temporal.columns)).cast("long").alias("n_columns"),
                 null.alias("confidencial_con_estado"), null.alias("confidencial_sin_estado"),
                 "flag_nacimiento_invalido", "flag_registro_antes_desaparicion"))


# ---- the canonical chain -------------------------------------------------

def clean_base(raw: DataFrame) -> DataFrame:
    """Raw text registry -> flagged, minimum-information rows removed, typed,
    normalised (D3, D5, E1-E3)."""
    from regmine.operators.block import confidentiality_flags, drop_minimum_info
    df = drop_minimum_info(confidentiality_flags(raw))
    return normalize_categories(to_text(to_nullable_long(df)))


def general_product(raw: DataFrame, min_ts=S.MIN_TS, max_ts=S.MAX_TS) -> DataFrame:
    """General working table: every remaining row plus parsed *_DT columns."""
    return parse_dates(clean_base(raw), min_ts=min_ts, max_ts=max_ts)


def temporal_product(general: DataFrame) -> DataFrame:
    """Temporal working table with all validation flags."""
    return chronology_flags(invalid_date_flags(null_date_flags(temporal_subset(general))))


def export_products(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """E11 + E12: the two serialisable products."""
    g = general_product(raw)
    t = temporal_product(g)
    return (project_general(serialize_dates(g, "general")),
            project_temporal(serialize_dates(t, "temporal")))
