"""Institution classes and the withheld block."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regmine import schema as S
from regmine.functions.numeric import r6, try_ratio
from regmine.functions.text import is_value


def _rule_hit(c: Column, include: str, exclude: str | None) -> Column:
    hit = c.contains(include)
    if exclude:
        hit = hit & ~c.contains(exclude)
    return F.coalesce(hit, F.lit(False))


def classify_sources(df: DataFrame, col: str = S.SOURCE, rules=None) -> DataFrame:
    """Number of distinct institutions matching each class pattern
    (classes are independent tests; a name may count in several)."""
    rules = rules or S.SOURCE_CLASS_RULES
    names = df.where(F.col(col).isNotNull()).select(F.col(col).alias("name")).distinct()
    agg = names.agg(*[F.count_if(_rule_hit(F.col("name"), inc, exc)).alias(label)
                      for label, inc, exc in rules])
    return agg.unpivot([], [r[0] for r in rules], "class", "n_sources").select(
        "class", F.col("n_sources").cast("long").alias("n_sources"))


def unclassified_sources(df: DataFrame, col: str = S.SOURCE, rules=None) -> DataFrame:
    """Institutions in none of the classes, with their report counts."""
    rules = rules or S.SOURCE_CLASS_RULES
    c = F.col(col)
    any_hit = F.lit(False)
    for _, inc, exc in rules:
        any_hit = any_hit | _rule_hit(c, inc, exc)
    return (df.where(c.isNotNull() & ~any_hit)
            .groupBy(c.alias("value")).agg(F.count(F.lit(1)).alias("count")))


def source_class_expr(c: Column) -> Column:
    """One class per report; the sub-office test precedes the office test."""
    return (F.when(c.contains("SUBPROCURADURIA"), F.lit("SUBPROCURADURIA"))
            .when(c.contains("PROCURADURIA"), F.lit("PROCURADURIA"))
            .when(c.contains("FISCALIA GENERAL DE"), F.lit("FISCALIA"))
            .when(c.contains("COMISION"), F.lit("COMISION"))
            .otherwise(F.lit("OTRAS")))


def source_class_counts(df: DataFrame, col: str = S.SOURCE) -> DataFrame:
    """Reports per institution class."""
    return df.groupBy(source_class_expr(F.col(col)).alias("class")).agg(
        F.count(F.lit(1)).alias("reports"))


def sentinel_counts(df: DataFrame, cols: list[str] | None = None,
                    sentinel: str = S.WITHHELD) -> DataFrame:
    """Rows equal to the sentinel, per column, one pass."""
    cols = cols or S.SENSITIVE_COLUMNS
    agg = df.agg(*[F.count_if(is_value(F.col(c), sentinel)).alias(c) for c in cols])
    return agg.unpivot([], cols, "column", "count").select(
        "column", F.col("count").cast("long").alias("count"))


def sentinel_block_equal(df: DataFrame, id_col: str = S.ID, cols: list[str] | None = None,
                         base: str = S.BIRTH, sentinel: str = S.WITHHELD) -> DataFrame:
    """Is the set of ids holding the sentinel in each column the same set as
    in ``base``?  Set semantics per id (one shuffle on id), no driver sets."""
    cols = cols or S.SENSITIVE_COLUMNS
    allc = list(dict.fromkeys([base] + cols))
    per_id = df.groupBy(id_col).agg(
        *[F.max(is_value(F.col(c), sentinel).cast("int")).alias(c) for c in allc])
    agg = per_id.agg(*[F.count_if(F.col(c) != F.col(base)).alias(c) for c in cols])
    return (agg.unpivot([], cols, "column", "differing_ids")
            .select("column", F.col("differing_ids").cast("long").alias("differing_ids"),
                    (F.col("differing_ids") == 0).cast("int").alias("same_set")))


def withheld_mask(proxy: str = S.BIRTH) -> Column:
    return is_value(F.col(proxy), S.WITHHELD)


def confidentiality_flags(df: DataFrame, proxy: str = S.BIRTH, state: str = S.STATE) -> DataFrame:
    """D3: withheld with known state / withheld without state (0/1, null-safe)."""
    w = withheld_mask(proxy)
    unknown_state = is_value(F.col(state), S.UNKNOWN)
    return df.withColumns({
        "confidencial_con_estado": (w & ~unknown_state).cast("int"),
        "confidencial_sin_estado": (w & unknown_state).cast("int"),
    })


def minimum_info_mask(proxy: str = S.BIRTH) -> Column:
    return (withheld_mask(proxy) & is_value(F.col(S.STATE), S.UNKNOWN)
            & is_value(F.col(S.SOURCE), S.UNKNOWN))


def minimum_info_summary(df: DataFrame) -> DataFrame:
    """Withheld-without-state rows, the minimum-information subset, percent."""
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(withheld_mask() & is_value(F.col(S.STATE), S.UNKNOWN))
                 .alias("withheld_no_state"),
                 F.count_if(minimum_info_mask()).alias("minimum_info"))
    return agg.select("n_rows", "withheld_no_state", "minimum_info",
                      r6(try_ratio(F.col("minimum_info") * 100, F.col("n_rows"))).alias("pct"))


def minimum_info_sources(df: DataFrame, k: int = 10) -> DataFrame:
    """Top-k reporting institutions among withheld rows without state."""
    sub = df.where(withheld_mask() & is_value(F.col(S.STATE), S.UNKNOWN))
    return (sub.groupBy(F.col(S.SOURCE).alias("value")).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "value").limit(k))


def drop_minimum_info(df: DataFrame) -> DataFrame:
    """Remove rows meeting all three conditions (null-safe negation)."""
    return df.where(~minimum_info_mask())


def withheld_total(df: DataFrame) -> DataFrame:
    """H4: unified withheld flag = with-state OR without-state."""
    return df.withColumn("confidencial_total",
                         F.greatest("confidencial_con_estado", "confidencial_sin_estado"))
