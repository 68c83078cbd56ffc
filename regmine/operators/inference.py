"""Types and date formats found from the data (A1, E5), by aggregates over all
rows; no sample and no value list reaches the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regmine.functions.dates import bounded
from regmine.session import materialize

INTEGER = r"^[+-]?[0-9]{1,18}$"
DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
SPARK_TYPE = {"integer": "bigint", "decimal": "double", "text": "string"}

# Shapes of date texts (every digit as 9) and the patterns they are
# read with; "{}" shapes begin with day or month.
DATE_SHAPES = {
    "9999-99-99": "yyyy-MM-dd", "9999/99/99": "yyyy/MM/dd",
    "9999-99-99 99:99": "yyyy-MM-dd HH:mm", "9999-99-99 99:99:99": "yyyy-MM-dd HH:mm:ss",
    "9999-99-99T99:99:99": "yyyy-MM-dd'T'HH:mm:ss", "9999/99/99 99:99:99": "yyyy/MM/dd HH:mm:ss",
    "99/99/9999": "{}/yyyy", "99-99-9999": "{}-yyyy",
    "99/99/9999 99:99": "{}/yyyy HH:mm", "99/99/9999 99:99:99": "{}/yyyy HH:mm:ss",
}


def _rank(c: Column) -> Column:
    """Place in the lattice null (0) < integer (1) < decimal (2) < text (3)."""
    t = F.trim(c)
    return (F.when(c.isNull(), 0).when(t.rlike(INTEGER), 1).when(t.rlike(DECIMAL), 2).otherwise(3))


def column_types(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A1: (column, type, has_null) of text columns whose null tokens are null
    already, from one aggregate.  An integer column with nulls is decimal, so is
    one without any value."""
    cols = cols or df.columns
    one = df.agg(*[F.max(_rank(F.col(c))).alias(f"r{i}") for i, c in enumerate(cols)],
                 *[F.max(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"r{i}").alias("r"), F.col(f"n{i}").alias("n"))
                     for i, c in enumerate(cols)])
    found = one.select(F.explode(rows).alias("x")).select("x.column", "x.r", F.coalesce("x.n", F.lit(False)).alias("n"))
    kind = (F.when(F.col("r") == 3, "text").when((F.col("r") == 1) & ~F.col("n"), "integer").otherwise("decimal"))
    return found.select("column", kind.alias("type"), F.col("n").alias("has_null"))


def cast_inferred(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A1: the columns in their inferred types (one aggregate, then a projection)."""
    kinds = {r["column"]: r["type"] for r in column_types(df, cols).collect()}     # one row a column
    return df.select(*[F.trim(F.col(c)).cast(SPARK_TYPE[kinds[c]]).alias(c) if kinds.get(c, "text") != "text"
                       else F.col(c) for c in df.columns])


def _shape(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), "[0-9]", "9")


def date_formats(df: DataFrame, cols: list[str]) -> dict:
    """E5: {column: (shape, pattern)} by the most frequent known shape of its
    texts (ties: the smaller shape), none if no text has one.  Where day and
    month could be either, the day comes first if a first number exceeds 12."""
    rows = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("t"))
                                        for c in cols]))).where(F.col("t").isNotNull())
    shapes = materialize(rows.groupBy("column", _shape(F.col("t")).alias("shape")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.substring(F.trim("t"), 1, 2)).alias("first")))
    out = {}
    for r in shapes.where(F.col("shape").isin(*DATE_SHAPES)).orderBy(F.desc("n"), "shape").collect():
        # at most one row a column and known shape
        if r["column"] not in out:
            pattern = DATE_SHAPES[r["shape"]]
            if "{}" in pattern:
                mark = pattern[2]
                pattern = pattern.format(f"dd{mark}MM" if r["first"] > "12" else f"MM{mark}dd")
            out[r["column"]] = (r["shape"], pattern)
    return out


def parse_dates_inferred(df: DataFrame, cols: list[str], suffix: str = "_DT", min_ts: str | None = None,
                         max_ts: str | None = None) -> DataFrame:
    """E5: ``<col>_DT`` by the format found for the column; texts of another
    format, and dates that do not exist, are null."""
    found = date_formats(df, cols)
    null = F.lit(None).cast("timestamp")
    return df.withColumns({c + suffix: bounded(F.when(_shape(F.col(c)) == found[c][0], F.try_to_timestamp(
        F.trim(F.col(c)), F.lit(found[c][1]))), min_ts, max_ts) if c in found else null for c in cols})
