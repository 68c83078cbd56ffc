"""Scans and sinks (A1-A3): CSV in with an explicit all-text schema, clean
products out as CSV or Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regmine import schema as S

# Default null tokens of the reference CSV reader (pandas' documented list).
DEFAULT_NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN",
                       "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN",
                       "None", "n/a", "nan", "null"]


MALFORMED = "_malformed"


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the file, in file order: reads one header line only."""
    return spark.read.option("header", True).option("inferSchema", False).option("escape", '"').csv(path).columns


def read_registry_text(spark: SparkSession, path: str, columns: list[str] | None = None,
                       multi_line: bool = False, malformed: str = "fail") -> DataFrame:
    """A2: every column text, chosen by its header name; only the empty field is
    null.  The schema is the header line, all text (no inference pass); quotes
    inside quoted fields are doubled.  A row with too few or too many fields
    fails the read; with ``malformed="report"`` it is kept and its raw line
    stands in ``_malformed`` (null for all other rows)."""
    from regmine.session import ensure_utc
    ensure_utc(spark)
    header = csv_header(spark, path)
    cols = columns or S.RAW_COLUMNS
    missing = [c for c in cols if c not in header]
    if missing:
        raise ValueError(f"columns {missing} are not in the header {header}")
    report = malformed == "report"
    schema = text_schema(header + [MALFORMED] * report)
    reader = (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
              .option("multiLine", multi_line).option("escape", '"').option("columnPruning", False)
              # an empty field is null, a quoted empty text is not: any value no
              # field can have tells them apart
              .option("nullValue", "\u0000"))
    if report:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED)
        # the reader checks the header against the schema, which has one column more
        reader = reader.option("enforceSchema", True)
    else:
        reader = reader.option("mode", "FAILFAST")
    return reader.csv(path).select(*cols, *[MALFORMED] * report)


def read_registry(spark: SparkSession, path: str, columns: list[str] | None = None,
                  null_tokens: list[str] | None = None, multi_line: bool = False,
                  malformed: str = "fail") -> DataFrame:
    """A1: CSV scan with the reader's default null tokens mapped to null.

    Typing happens later with try_* functions (E1, E4); sentinels stay text.
    """
    tokens = DEFAULT_NULL_TOKENS if null_tokens is None else null_tokens
    df = read_registry_text(spark, path, columns, multi_line, malformed)
    if not tokens:
        return df
    tok = F.array(*[F.lit(t) for t in tokens])
    return df.select([F.col(c) if c == MALFORMED else
                      F.when(F.array_contains(tok, F.col(c)), F.lit(None).cast("string"))
                      .otherwise(F.col(c)).alias(c) for c in df.columns])


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with header; whitespace kept as is (the writer trims by default),
    quotes doubled, nulls as empty fields, empty strings quoted."""
    (df.write.mode(mode).option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).option("nullValue", "").option("emptyValue", '""')
     .option("escape", '"').csv(path))


def write_products(products: dict[str, DataFrame], path: str, fmt: str = "parquet",
                   mode: str = "overwrite") -> dict[str, str]:
    """A3: write each product once (no index column, nulls as empty in CSV)."""
    out = {}
    for name, df in products.items():
        target = f"{path.rstrip('/')}/{name}"
        if fmt == "csv":
            write_csv(df, target, mode)
        else:
            df.write.mode(mode).parquet(target)
        out[name] = target
    return out


def read_product(spark: SparkSession, path: str, fmt: str = "parquet",
                 schema: T.StructType | None = None) -> DataFrame:
    """A product as written; CSV comes back as text, or cast to ``schema``."""
    if fmt != "csv":
        return spark.read.parquet(path)
    names = schema.names if schema else csv_header(spark, path)
    df = read_registry_text(spark, path, names)
    return df.select([F.col(f.name).cast(f.dataType) for f in schema.fields]) if schema else df
