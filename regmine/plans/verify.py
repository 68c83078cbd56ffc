"""Side-by-side check of a Spark plan against its SQL oracle (DuckDB).

Used by the tests and by ``check_oracle.py``: same column names, same row
count, same multiset of rows after normalising values (doubles rounded,
timestamps as text).
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits=6):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, digits)
        return 0.0 if r == 0 else r
    if isinstance(v, decimal.Decimal):
        return _norm(float(v), digits)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, _dt.datetime) else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__), x if x is not None else 0) for x in row)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT", "boolean": "BOOLEAN"}


def compare(spark_df, sql: str, con, digits: int = 6) -> dict:
    s_cols = spark_df.columns
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in spark_df.schema.fields}
    s_rows = [tuple(_norm(v, digits) for v in r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = {c: str(t) for c, t in zip(d_cols, rel.types)}
    d_rows_raw = rel.fetchall()
    res = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows_raw),
           "columns_match": sorted(s_cols) == sorted(d_cols),
           "types_match": s_types == d_types}
    if not res["types_match"]:
        res["type_diff"] = {c: (s_types.get(c), d_types.get(c)) for c in set(s_types) | set(d_types)
                            if s_types.get(c) != d_types.get(c)}
    if not res["columns_match"]:
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
        res["match"] = False
        return res
    order = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(_norm(r[i], digits) for i in order) for r in d_rows_raw]
    a, b = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
    res["match"] = (a == b) and res["types_match"]
    if not res["match"]:
        only_s = [r for r in a if r not in set(b)][:5]
        only_d = [r for r in b if r not in set(a)][:5]
        res["only_spark"], res["only_oracle"] = only_s, only_d
    return res
