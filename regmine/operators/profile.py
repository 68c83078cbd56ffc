"""Profiling (B1-B12): shapes, null and distinct counts, format census,
value counts and duplicates.  Each function is one pass (one aggregate) over
its input; several columns are merged into one ``agg`` and then unpivoted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regmine.functions.numeric import r6, try_ratio


def _long_table(df_one_row: DataFrame, cols: list[str], name: str, value: str) -> DataFrame:
    return df_one_row.unpivot([], cols, name, value)


def table_shape(df: DataFrame) -> DataFrame:
    """B1: row and column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns"))


def column_profile(df: DataFrame) -> DataFrame:
    """B2: (column, dtype, non_null, position) in one pass."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    types = F.create_map(*[x for f in df.schema.fields
                           for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    pos = F.create_map(*[x for i, c in enumerate(df.columns) for x in (F.lit(c), F.lit(i))])
    return (_long_table(counts, df.columns, "column", "non_null")
            .select("column", types[F.col("column")].alias("dtype"),
                    F.col("non_null").cast("long").alias("non_null"),
                    pos[F.col("column")].cast("long").alias("position")))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Nulls per column, all columns in one aggregate."""
    cols = cols or df.columns
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _long_table(agg, cols, "column", "nulls").select(
        "column", F.col("nulls").cast("long").alias("nulls"))


def value_counts(df: DataFrame, col: str, order: str = "count") -> DataFrame:
    """Frequency of each non-null value; ``order`` 'count' or 'value'."""
    vc = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(
        F.count(F.lit(1)).alias("count"))
    if order == "value":
        return vc.orderBy("value")
    return vc.orderBy(F.desc("count"), "value")


def n_distinct(df: DataFrame, cols: list[str] | None = None, approx: bool = False,
               rsd: float = 0.01) -> DataFrame:
    """Distinct non-null values per column (exact, or HyperLogLog++)."""
    cols = cols or df.columns
    fn = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.count_distinct
    agg = df.agg(*[fn(F.col(c)).alias(c) for c in cols])
    return _long_table(agg, cols, "column", "n_distinct").select(
        "column", F.col("n_distinct").cast("long").alias("n_distinct"))


def format_census(df: DataFrame, col: str, sentinel: str, regex: str,
                  ignore_case: bool = False) -> DataFrame:
    """Nulls, sentinel hits (substring), pattern-valid values, and shares."""
    c = F.col(col)
    hit = (F.upper(c).contains(sentinel.upper()) if ignore_case else c.contains(sentinel))
    agg = df.agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(c.isNull()).alias("nulls"),
                 F.count_if(F.coalesce(hit, F.lit(False))).alias("sentinel"),
                 F.count_if(F.coalesce(c.rlike(regex), F.lit(False))).alias("valid"))
    return agg.select(
        F.lit(col).alias("column"), "total", "nulls", "sentinel", "valid",
        r6(try_ratio(F.col("nulls"), F.col("total"))).alias("nulls_share"),
        r6(try_ratio(F.col("sentinel"), F.col("total"))).alias("sentinel_share"),
        r6(try_ratio(F.col("valid"), F.col("total"))).alias("valid_share"))


def category_lookup(df: DataFrame, col: str, keys: list[str]) -> DataFrame:
    """Count of selected categories (0 when absent) plus a combined row."""
    c = F.col(col)
    aggs = [F.count_if(c.eqNullSafe(F.lit(k))).alias(f"k{i}") for i, k in enumerate(keys)]
    agg = df.agg(F.count(F.lit(1)).alias("total"), *aggs)
    combined = sum((F.col(f"k{i}") for i in range(len(keys))), F.lit(0))
    stacked = F.array(*[F.struct(F.lit(k).alias("key"), F.col(f"k{i}").cast("long").alias("count"))
                        for i, k in enumerate(keys)],
                      F.struct(F.lit("TOTAL").alias("key"), combined.cast("long").alias("count")))
    return (agg.select("total", F.inline(stacked))
            .select("key", "count", r6(try_ratio(F.col("count") * 100, F.col("total"))).alias("pct")))


def code_label_counts(df: DataFrame, code_col: str, code: int, label_col: str,
                      label: str) -> DataFrame:
    """Rows with the special code, rows with the label, and whether they agree."""
    code_v = F.col(code_col).try_cast("double")
    agg = df.agg(F.count_if(F.coalesce(code_v == code, F.lit(False))).alias("code_rows"),
                 F.count_if(F.col(label_col).eqNullSafe(F.lit(label))).alias("label_rows"))
    return agg.select("code_rows", "label_rows",
                      (F.col("code_rows") == F.col("label_rows")).cast("int").alias("agree"))


def top_values(df: DataFrame, col: str, n: int = 10, last: bool = False) -> DataFrame:
    """First (or last) n rows of the frequency table (a TakeOrdered)."""
    vc = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(
        F.count(F.lit(1)).alias("count"))
    if last:
        return vc.orderBy(F.asc("count"), F.desc("value")).limit(n)
    return vc.orderBy(F.desc("count"), F.asc("value")).limit(n)


def missing_summary(df: DataFrame, cols: list[str],
                    decision: str = "Se conserva como nulo; no se imputa") -> DataFrame:
    """Column, nulls, percent of rows (2 dp), decision text."""
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return (agg.unpivot(["__n"], cols, "column", "nulls")
            .select("column", F.col("nulls").cast("long").alias("nulls"),
                    r6(F.round(try_ratio(F.col("nulls") * 100, F.col("__n")), 2)).alias("pct"),
                    F.lit(decision).alias("decision")))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows after the first copy (nulls compare equal, as in groupBy).
    Partial aggregation absorbs a hot duplicate group before the shuffle."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("c"))
    return g.agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).cast("long").alias("duplicates"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key already appeared."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
    return g.agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).cast("long").alias("duplicates"))
