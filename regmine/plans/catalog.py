"""Registered queries: one per operator of the inventory.

Each query is ``(spark, sf_dir) -> DataFrame`` over the whole test tables (via
the derived registry view) and, where SQL can express it, has an oracle in
:data:`ORACLE` with the same column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regmine import schema as S
from regmine.functions.numeric import r6, scalars
from regmine.operators import (anomalies as K, block as B2, classify as J, clean as E,
                               concentration as C, correlate as H, features as FE,
                               inference as IN, itemsets as I, profile as B, rules as R, stats as G, vertical as V)
from regmine.plans import oracle as O
from regmine.session import remove, scratch
from regmine.sources import io as IO
from regmine.sources.registry import registry_view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _bigint_count_if(sql: str) -> str:
    """DuckDB's count_if returns HUGEINT; Spark's returns BIGINT.  Wrap every
    call (balanced parentheses) so that both engines report the same type."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + "CAST(" + _bigint_count_if_inner(sql[j:k]) + " AS BIGINT)")
        i = k


def _bigint_count_if_inner(call: str) -> str:
    head, body = call[:len("count_if(")], call[len("count_if("):-1]
    return head + _bigint_count_if(body) + ")"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = _bigint_count_if(sql)
        return fn
    return deco


# ---- shared inputs (lazy plans, rebuilt per call) --------------------------

def raw(spark, sf):
    return registry_view(spark, sf)


def general(spark, sf):
    return E.general_product(raw(spark, sf))


def temporal(spark, sf):
    return E.temporal_product(general(spark, sf))


def measures(spark, sf):
    t = temporal(spark, sf)
    return FE.delay_days(FE.age_years_diff(t))


def mining(spark, sf):
    return FE.mining_table(raw(spark, sf))


def transactions(spark, sf):
    return I.to_transactions(mining(spark, sf), S.ITEM_COLUMNS, id_col=S.ID)


def transactions_years(spark, sf):
    """Earlier item set: status and calendar years instead of terms."""
    return I.to_transactions(FE.mining_table(raw(spark, sf), years=True), S.ITEM_COLUMNS_YEARS,
                             id_col=S.ID)


def mined(spark, sf, algo: str = "apriori", years: bool = False):
    """Frequent itemsets of the mining transactions, mined anew in every query."""
    tx = transactions_years(spark, sf) if years else transactions(spark, sf)
    miner = {"apriori": I.apriori, "bitmaps": V.apriori_bitmaps, "fpgrowth": I.fp_growth}[algo]
    return miner(tx, 0.02, 3)


def rules(spark, sf, years: bool = False):
    m = mined(spark, sf, years=years)
    return R.generate_rules(m.itemsets, m.n_transactions, 0.70)


def _cols_sql(cols, fmt, sep=" UNION ALL "):
    return sep.join(fmt.format(c=c, i=i) for i, c in enumerate(cols))


P_RAW, P_CLEAN, P_MIN = O.PREFIX_RAW, O.PREFIX_CLEAN, O.PREFIX_MINING
RAW_COLS = S.RAW_COLUMNS

# ---- A: scans and sinks ----------------------------------------------------


def _csv_round_trip(spark, df, read):
    """Write ``df`` as CSV to shared storage, read it back with ``read``; the
    CSV goes when the result has been read."""
    path = scratch(spark, "csv")
    IO.write_csv(df, path)
    out = I._checkpoint(read(path))
    remove(spark, path)
    return out


@register("a1_read_registry", P_RAW + "SELECT * FROM registry")
def a1(spark, sf):
    """Write the registry as CSV to shared storage, scan it back (A1)."""
    return _csv_round_trip(spark, raw(spark, sf), lambda p: IO.read_registry(spark, p))


_TYPE_SQL = " UNION ALL ".join(f"""SELECT '{c}' AS "column", CASE WHEN r = 3 THEN 'text'
  WHEN r = 1 AND NOT n THEN 'integer' ELSE 'decimal' END AS "type", n AS has_null FROM (
  SELECT max(CASE WHEN {c} IS NULL THEN 0 WHEN regexp_full_match(trim({c}), '[+-]?[0-9]{{1,18}}') THEN 1
    WHEN regexp_full_match(trim({c}), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN 2 ELSE 3 END) AS r,
    bool_or({c} IS NULL) AS n FROM typed)""" for c in RAW_COLS)


@register("a1_inferred_types", O.with_ctes(O.REGISTRY, "typed AS (SELECT " + ", ".join(
    f"CASE WHEN {c} NOT IN ('SE DESCONOCE', 'CONFIDENCIAL') THEN {c} END AS {c}" for c in RAW_COLS)
    + " FROM registry)") + _TYPE_SQL)
def a1i(spark, sf):
    """A1 with both sentinels read as null: the type of every column."""
    df = _csv_round_trip(spark, raw(spark, sf), lambda p: IO.read_registry(
        spark, p, null_tokens=[*IO.DEFAULT_NULL_TOKENS, S.UNKNOWN, S.WITHHELD]))
    return IN.column_types(df)


@register("a1_read_registry_null_tokens", P_RAW + "SELECT " + ", ".join(
    f"nullif({c}, 'SE DESCONOCE') AS {c}" for c in RAW_COLS) + " FROM registry")
def a1t(spark, sf):
    """A1 with another token read as null, columns in another order in the file."""
    df = raw(spark, sf).select(*reversed(RAW_COLS))
    return _csv_round_trip(spark, df, lambda p: IO.read_registry(spark, p, null_tokens=[S.UNKNOWN]))


@register("a2_read_registry_text", P_RAW + "SELECT * FROM registry")
def a2(spark, sf):
    return _csv_round_trip(spark, raw(spark, sf), lambda p: IO.read_registry_text(spark, p))


@register("a3_write_products", P_CLEAN + """
SELECT ID_VICTIMA, ORIGEN_REPORTE, FECHA_NACIMIENTO, strftime(FECHA_NACIMIENTO_DT, '%Y-%m-%d') AS FECHA_NACIMIENTO_LIMPIA,
  SEXO, FECHA_DESAPARICION, strftime(FECHA_DESAPARICION_DT, '%Y-%m-%d %H:%M:%S') AS FECHA_DESAPARICION_LIMPIA,
  FECHA_REGISTRO, strftime(FECHA_REGISTRO_DT, '%Y-%m-%d %H:%M:%S') AS FECHA_REGISTRO_LIMPIA,
  ESTATUS_VICTIMA, CVE_ENT, ENTIDAD, CVE_MUN, MUNICIPIO, confidencial_con_estado, confidencial_sin_estado
FROM general""")
def a3(spark, sf):
    return _product(spark, sf, "general", "parquet")


def _product(spark, sf, name, fmt):
    """Both products written, one read back."""
    g, t = E.export_products(raw(spark, sf))
    path = scratch(spark, "products")
    out = IO.write_products({"general": g, "temporal": t}, path, fmt=fmt)
    back = I._checkpoint(IO.read_product(spark, out[name], fmt, {"general": g, "temporal": t}[name].schema))
    remove(spark, path)
    return back


@register("a3_write_products_csv_general", ORACLE["a3_write_products"])
def a3cg(spark, sf):
    return _product(spark, sf, "general", "csv")


# ---- B: profiling (raw registry) --------------------------------------------

@register("b1_table_shape", P_RAW + "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM registry")
def b1(spark, sf):
    return B.table_shape(raw(spark, sf))


@register("b2_column_profile", P_RAW + _cols_sql(
    RAW_COLS, "SELECT '{c}' AS \"column\", 'string' AS dtype, count({c}) AS non_null, "
              "CAST({i} AS BIGINT) AS position FROM registry"))
def b2(spark, sf):
    return B.column_profile(raw(spark, sf))


@register("b3_null_counts", P_RAW + _cols_sql(
    RAW_COLS, "SELECT '{c}' AS \"column\", count_if({c} IS NULL) AS nulls FROM registry"))
def b3(spark, sf):
    return B.null_counts(raw(spark, sf))


@register("b4_value_counts", P_RAW + """SELECT ORIGEN_REPORTE AS value, count(*) AS count FROM registry
WHERE ORIGEN_REPORTE IS NOT NULL GROUP BY 1""")
def b4(spark, sf):
    return B.value_counts(raw(spark, sf), S.SOURCE)


@register("b5_n_distinct", P_RAW + _cols_sql(
    RAW_COLS, "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM registry"))
def b5(spark, sf):
    return B.n_distinct(raw(spark, sf))


_CENSUS = [("FECHA_NACIMIENTO", r"^\d{4}-\d{2}-\d{2}$", False),
           ("FECHA_DESAPARICION", r"^\d{4}-\d{2}-\d{2}\s\d{2}:\d{2}:\d{2}$", True),
           ("FECHA_REGISTRO", r"^\d{4}-\d{2}-\d{2}\s\d{2}:\d{2}:\d{2}$", True)]


def _census_sql(c, rx, ic):
    hit = f"upper({c}) LIKE '%CONFIDENCIAL%'" if ic else f"{c} LIKE '%CONFIDENCIAL%'"
    return (f"SELECT '{c}' AS \"column\", count(*) AS total, count_if({c} IS NULL) AS nulls, "
            f"count_if(coalesce({hit}, false)) AS sentinel, "
            f"count_if(coalesce(regexp_matches({c}, '{rx}'), false)) AS valid, "
            f"round(count_if({c} IS NULL) / count(*), 6) AS nulls_share, "
            f"round(count_if(coalesce({hit}, false)) / count(*), 6) AS sentinel_share, "
            f"round(count_if(coalesce(regexp_matches({c}, '{rx}'), false)) / count(*), 6) AS valid_share "
            f"FROM registry")


@register("b6_format_census", P_RAW + " UNION ALL ".join(_census_sql(*x) for x in _CENSUS))
def b6(spark, sf):
    r = raw(spark, sf)
    parts = [B.format_census(r, c, S.WITHHELD, rx, ic) for c, rx, ic in _CENSUS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("b7_category_lookup", P_RAW + """
SELECT key, count, round(count * 100.0 / total, 6) AS pct FROM (
  SELECT 'CONFIDENCIAL' AS key, count_if(MUNICIPIO = 'CONFIDENCIAL') AS count, count(*) AS total FROM registry
  UNION ALL SELECT 'SE DESCONOCE', count_if(MUNICIPIO = 'SE DESCONOCE'), count(*) FROM registry
  UNION ALL SELECT 'NO EXISTE', count_if(MUNICIPIO = 'NO EXISTE'), count(*) FROM registry
  UNION ALL SELECT 'TOTAL', count_if(MUNICIPIO IN ('CONFIDENCIAL', 'SE DESCONOCE', 'NO EXISTE')), count(*) FROM registry)""")
def b7(spark, sf):
    return B.category_lookup(raw(spark, sf), S.MUNI, [S.WITHHELD, S.UNKNOWN, "NO EXISTE"])


@register("b8_code_label_counts", P_RAW + """
SELECT count_if(coalesce(TRY_CAST(CVE_ENT AS DOUBLE) = 99, false)) AS code_rows,
       count_if(ENTIDAD IS NOT DISTINCT FROM 'SE DESCONOCE') AS label_rows,
       CAST(count_if(coalesce(TRY_CAST(CVE_ENT AS DOUBLE) = 99, false))
            = count_if(ENTIDAD IS NOT DISTINCT FROM 'SE DESCONOCE') AS INTEGER) AS agree FROM registry""")
def b8(spark, sf):
    return B.code_label_counts(raw(spark, sf), S.STATE_CODE, 99, S.STATE, S.UNKNOWN)


@register("b9_top_values", P_RAW + """SELECT ORIGEN_REPORTE AS value, count(*) AS count FROM registry
WHERE ORIGEN_REPORTE IS NOT NULL GROUP BY 1 ORDER BY count DESC, value LIMIT 10""")
def b9(spark, sf):
    return B.top_values(raw(spark, sf), S.SOURCE, 10)


_MISS = [S.BIRTH, S.DISAPPEARED, S.REGISTERED]


@register("b10_missing_summary", P_CLEAN + _cols_sql(
    _MISS, "SELECT '{c}' AS \"column\", count_if({c} IS NULL) AS nulls, "
           "round(round(count_if({c} IS NULL) * 100.0 / count(*), 2), 6) AS pct, "
           "'Se conserva como nulo; no se imputa' AS decision FROM base"))
def b10(spark, sf):
    from regmine.operators.block import confidentiality_flags, drop_minimum_info
    return B.missing_summary(drop_minimum_info(confidentiality_flags(raw(spark, sf))), _MISS)


@register("b11_duplicate_rows", P_RAW + """SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicates
FROM (SELECT count(*) AS c FROM registry GROUP BY ALL_COLS)""".replace("ALL_COLS", ", ".join(RAW_COLS)))
def b11(spark, sf):
    return B.duplicate_rows(raw(spark, sf))


_LINEITEM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
             "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("b11_duplicate_rows_lineitem", f"""SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicates
FROM (SELECT count(*) AS c FROM lineitem GROUP BY {', '.join(_LINEITEM)})""")
def b11l(spark, sf):
    return B.duplicate_rows(spark.read.parquet(f"{sf}/lineitem.parquet"))


@register("b12_duplicate_keys", P_RAW + """SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicates
FROM (SELECT count(*) AS c FROM registry GROUP BY ID_VICTIMA)""")
def b12(spark, sf):
    return B.duplicate_keys(raw(spark, sf), [S.ID])


@register("b12_duplicate_keys_lineitem", """SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicates
FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def b12l(spark, sf):
    return B.duplicate_keys(spark.read.parquet(f"{sf}/lineitem.parquet"), ["l_orderkey", "l_linenumber"])


# ---- C, D: institution classes and the withheld block -----------------------

_SRC = "(SELECT DISTINCT ORIGEN_REPORTE AS name FROM registry WHERE ORIGEN_REPORTE IS NOT NULL)"


@register("c1_classify_sources", P_RAW + f"""
SELECT 'COMISION' AS class, count_if(name LIKE '%COMISION%') AS n_sources FROM {_SRC}
UNION ALL SELECT 'FISCALIA', count_if(name LIKE '%FISCALIA GENERAL DE%') FROM {_SRC}
UNION ALL SELECT 'PROCURADURIA', count_if(name LIKE '%PROCURADURIA%' AND name NOT LIKE '%SUBPROCURADURIA%') FROM {_SRC}
UNION ALL SELECT 'SUBPROCURADURIA', count_if(name LIKE '%SUBPROCURADURIA%') FROM {_SRC}""")
def c1(spark, sf):
    return B2.classify_sources(raw(spark, sf))


@register("c2_unclassified_sources", P_RAW + """
SELECT ORIGEN_REPORTE AS value, count(*) AS count FROM registry
WHERE ORIGEN_REPORTE IS NOT NULL AND NOT (ORIGEN_REPORTE LIKE '%COMISION%' OR ORIGEN_REPORTE LIKE '%FISCALIA GENERAL DE%'
  OR ORIGEN_REPORTE LIKE '%PROCURADURIA%' OR ORIGEN_REPORTE LIKE '%SUBPROCURADURIA%')
GROUP BY 1""")
def c2(spark, sf):
    return B2.unclassified_sources(raw(spark, sf))


@register("c3_source_class_counts", P_RAW + """
SELECT CASE WHEN ORIGEN_REPORTE LIKE '%SUBPROCURADURIA%' THEN 'SUBPROCURADURIA'
            WHEN ORIGEN_REPORTE LIKE '%PROCURADURIA%' THEN 'PROCURADURIA'
            WHEN ORIGEN_REPORTE LIKE '%FISCALIA GENERAL DE%' THEN 'FISCALIA'
            WHEN ORIGEN_REPORTE LIKE '%COMISION%' THEN 'COMISION' ELSE 'OTRAS' END AS class,
       count(*) AS reports FROM registry GROUP BY 1""")
def c3(spark, sf):
    return B2.source_class_counts(raw(spark, sf))


_SENS = S.SENSITIVE_COLUMNS


@register("d1_sentinel_counts", P_RAW + _cols_sql(
    _SENS, "SELECT '{c}' AS \"column\", count_if({c} IS NOT DISTINCT FROM 'CONFIDENCIAL') AS count FROM registry"))
def d1(spark, sf):
    return B2.sentinel_counts(raw(spark, sf))


_PER_ID = ("per_id AS (SELECT ID_VICTIMA, max(CAST(FECHA_NACIMIENTO IS NOT DISTINCT FROM 'CONFIDENCIAL' "
           "AS INTEGER)) AS f_base, " + ", ".join(
               f"max(CAST({c} IS NOT DISTINCT FROM 'CONFIDENCIAL' AS INTEGER)) AS f_{c}" for c in _SENS)
           + " FROM registry GROUP BY ID_VICTIMA)")


@register("d2_sentinel_block_equal", O.with_ctes(O.REGISTRY, _PER_ID) + (
    "SELECT \"column\", differing_ids, CAST(differing_ids = 0 AS INTEGER) AS same_set FROM ("
    + _cols_sql(_SENS, "SELECT '{c}' AS \"column\", count_if(f_{c} <> f_base) AS differing_ids FROM per_id")
    + ")"))
def d2(spark, sf):
    return B2.sentinel_block_equal(raw(spark, sf))


@register("d3_confidentiality_flags", P_CLEAN + """SELECT ID_VICTIMA, confidencial_con_estado,
confidencial_sin_estado FROM flagged""")
def d3(spark, sf):
    return B2.confidentiality_flags(raw(spark, sf)).select(
        S.ID, "confidencial_con_estado", "confidencial_sin_estado")


@register("d4_minimum_info_report", P_CLEAN + """
SELECT count(*) AS n_rows, count_if(confidencial_sin_estado = 1) AS withheld_no_state,
  count_if(confidencial_sin_estado = 1 AND ORIGEN_REPORTE IS NOT DISTINCT FROM 'SE DESCONOCE') AS minimum_info,
  round(count_if(confidencial_sin_estado = 1 AND ORIGEN_REPORTE IS NOT DISTINCT FROM 'SE DESCONOCE') * 100.0
        / count(*), 6) AS pct FROM flagged""")
def d4(spark, sf):
    return B2.minimum_info_summary(raw(spark, sf))


@register("d4_minimum_info_sources", P_CLEAN + """
SELECT ORIGEN_REPORTE AS value, count(*) AS count FROM flagged WHERE confidencial_sin_estado = 1
GROUP BY 1 ORDER BY count DESC, value LIMIT 10""")
def d4s(spark, sf):
    return B2.minimum_info_sources(raw(spark, sf))


@register("d5_drop_minimum_info", P_CLEAN + "SELECT ID_VICTIMA FROM base")
def d5(spark, sf):
    return B2.drop_minimum_info(raw(spark, sf)).select(S.ID)


# ---- E: cleaning, validation, export ----------------------------------------

def _typed(spark, sf):
    return E.clean_base(raw(spark, sf))


@register("e1_to_nullable_long", P_CLEAN + "SELECT ID_VICTIMA, CVE_ENT, CVE_MUN FROM typed")
def e1(spark, sf):
    return _typed(spark, sf).select(S.ID, S.STATE_CODE, S.MUNI_CODE)


@register("e2_to_text", P_CLEAN + """SELECT ID_VICTIMA, FECHA_NACIMIENTO, FECHA_DESAPARICION, FECHA_REGISTRO
FROM base""")
def e2(spark, sf):
    return E.to_text(B2.drop_minimum_info(raw(spark, sf))).select(S.ID, *S.DATE_COLUMNS)


def _norm_report_sql():
    cols = S.CATEGORY_COLUMNS
    b = _cols_sql(cols, "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS before FROM base")
    a = _cols_sql(cols, "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS after FROM typed")
    return P_CLEAN + f"SELECT b.\"column\", b.before, a.after FROM ({b}) b JOIN ({a}) a USING (\"column\")"


@register("e3_normalize_categories", _norm_report_sql())
def e3(spark, sf):
    before = B2.drop_minimum_info(B2.confidentiality_flags(raw(spark, sf)))
    return E.normalization_report(before, E.normalize_categories(before))


@register("e3_normalized_values", P_CLEAN + """SELECT ID_VICTIMA, ORIGEN_REPORTE, SEXO, ESTATUS_VICTIMA, ENTIDAD,
MUNICIPIO FROM typed""")
def e3v(spark, sf):
    return _typed(spark, sf).select(S.ID, *S.CATEGORY_COLUMNS)


def _fmt_dt_spark(df, cols):
    return df.select(S.ID, *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in cols])


_DTS = [S.BIRTH + "_DT", S.DISAPPEARED + "_DT", S.REGISTERED + "_DT"]
_DT_SQL = ", ".join(f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in _DTS)


@register("e4_parse_dates", P_CLEAN + f"SELECT ID_VICTIMA, {_DT_SQL} FROM general")
def e4(spark, sf):
    return _fmt_dt_spark(general(spark, sf), _DTS)


@register("e5_parse_dates_any", P_MIN + """SELECT ID_VICTIMA,
  strftime(NAC_DT, '%Y-%m-%d %H:%M:%S') AS FECHA_NACIMIENTO_DT,
  strftime(DIS_DT, '%Y-%m-%d %H:%M:%S') AS FECHA_DESAPARICION_DT,
  strftime(REG_DT, '%Y-%m-%d %H:%M:%S') AS FECHA_REGISTRO_DT FROM mining""")
def e5(spark, sf):
    return _fmt_dt_spark(mining(spark, sf), _DTS)


@register("e5_parse_dates_undeclared", O.with_ctes(O.REGISTRY, """
u AS (SELECT ID_VICTIMA, 'birth' AS kind, FECHA_NACIMIENTO AS t FROM registry
      UNION ALL SELECT ID_VICTIMA, 'event', FECHA_DESAPARICION FROM registry),
best AS (SELECT regexp_replace(t, '[0-9]', '9', 'g') AS s FROM u
         WHERE regexp_replace(t, '[0-9]', '9', 'g') IN ('9999-99-99', '9999-99-99 99:99:99')
         GROUP BY 1 ORDER BY count(*) DESC, s LIMIT 1)""") + """
SELECT ID_VICTIMA, kind, strftime(CASE WHEN (SELECT s FROM best) = '9999-99-99' THEN try_strptime(t, '%Y-%m-%d')
  ELSE try_strptime(t, '%Y-%m-%d %H:%M:%S') END, '%Y-%m-%d %H:%M:%S') AS parsed FROM u""")
def e5u(spark, sf):
    """E5 on a column of two formats, neither declared."""
    r = raw(spark, sf)
    u = (r.select(S.ID, F.lit("birth").alias("kind"), F.col(S.BIRTH).alias("t"))
         .unionByName(r.select(S.ID, F.lit("event").alias("kind"), F.col(S.DISAPPEARED).alias("t"))))
    return IN.parse_dates_inferred(u, ["t"]).select(
        S.ID, "kind", F.date_format("t_DT", "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@register("e6_temporal_subset", P_CLEAN + "SELECT ID_VICTIMA FROM temporal")
def e6(spark, sf):
    return E.temporal_subset(general(spark, sf)).select(S.ID)


def _flag_sql(flags, src="temporal"):
    return P_CLEAN + _cols_sql(flags, "SELECT '{c}' AS flag, CAST(coalesce(sum({c}), 0) AS BIGINT) AS total FROM "
                               + src)


_NULLF = list(E.NULL_FLAGS)
_INVF = list(E.INVALID_FLAGS)
_CHRF = list(E.CHRONO_FLAGS)


@register("e7_null_date_flags", _flag_sql(_NULLF))
def e7(spark, sf):
    return E.flag_sums(temporal(spark, sf), _NULLF)


@register("e8_code_label_mismatches", P_CLEAN + """SELECT count_if(coalesce(
  (CVE_ENT = 99 AND ENTIDAD IS DISTINCT FROM 'SE DESCONOCE') OR
  (CVE_ENT <> 99 AND ENTIDAD IS NOT DISTINCT FROM 'SE DESCONOCE'), false)) AS mismatches FROM general""")
def e8(spark, sf):
    return E.code_label_mismatches(general(spark, sf))


@register("e9_invalid_date_flags", _flag_sql(_INVF))
def e9(spark, sf):
    return E.flag_sums(temporal(spark, sf), _INVF)


@register("e9_invalid_date_rows", P_CLEAN + """SELECT ID_VICTIMA, FECHA_NACIMIENTO FROM temporal
WHERE flag_nacimiento_invalido = 1""")
def e9r(spark, sf):
    return E.invalid_date_rows(temporal(spark, sf))


@register("e10_chronology_flags", _flag_sql(_CHRF))
def e10(spark, sf):
    return E.flag_sums(temporal(spark, sf), _CHRF)


@register("e11_serialize_dates", P_CLEAN + """SELECT ID_VICTIMA,
  strftime(FECHA_NACIMIENTO_DT, '%Y-%m-%d') AS FECHA_NACIMIENTO_LIMPIA,
  strftime(FECHA_DESAPARICION_DT, '%Y-%m-%d %H:%M:%S') AS FECHA_DESAPARICION_LIMPIA,
  strftime(FECHA_REGISTRO_DT, '%Y-%m-%d %H:%M:%S') AS FECHA_REGISTRO_LIMPIA FROM general""")
def e11(spark, sf):
    return E.serialize_dates(general(spark, sf), "general").select(
        S.ID, "FECHA_NACIMIENTO_LIMPIA", "FECHA_DESAPARICION_LIMPIA", "FECHA_REGISTRO_LIMPIA")


@register("e12_project_general", ORACLE["a3_write_products"])
def e12(spark, sf):
    return E.export_products(raw(spark, sf))[0]


@register("e12_project_temporal", P_CLEAN + """
SELECT ID_VICTIMA, ORIGEN_REPORTE, strftime(FECHA_NACIMIENTO_DT, '%Y-%m-%d') AS FECHA_NACIMIENTO, SEXO,
  strftime(FECHA_DESAPARICION_DT, '%Y-%m-%d %H:%M:%S') AS FECHA_DESAPARICION,
  strftime(FECHA_REGISTRO_DT, '%Y-%m-%d %H:%M:%S') AS FECHA_REGISTRO, ESTATUS_VICTIMA, CVE_ENT, ENTIDAD, CVE_MUN,
  MUNICIPIO, nulo_fecha_nacimiento, nulo_fecha_desaparicion, nulo_fecha_registro, flag_nacimiento_invalido,
  flag_nacimiento_despues_desaparicion, flag_nacimiento_despues_registro, flag_registro_antes_desaparicion
FROM temporal""")
def e12t(spark, sf):
    return E.export_products(raw(spark, sf))[1]


@register("a3_write_products_csv_temporal", ORACLE["e12_project_temporal"])
def a3ct(spark, sf):
    return _product(spark, sf, "temporal", "csv")


@register("e13_export_summary", P_CLEAN + """
SELECT 'general' AS product, count(*) AS n_rows, CAST(16 AS BIGINT) AS n_columns,
  CAST(sum(confidencial_con_estado) AS BIGINT) AS confidencial_con_estado,
  CAST(sum(confidencial_sin_estado) AS BIGINT) AS confidencial_sin_estado,
  CAST(NULL AS BIGINT) AS flag_nacimiento_invalido, CAST(NULL AS BIGINT) AS flag_registro_antes_desaparicion
FROM general
UNION ALL
SELECT 'temporal', count(*), CAST(18 AS BIGINT), NULL, NULL, CAST(sum(flag_nacimiento_invalido) AS BIGINT),
  CAST(sum(flag_registro_antes_desaparicion) AS BIGINT) FROM temporal""")
def e13(spark, sf):
    g, t = E.export_products(raw(spark, sf))
    return E.export_summary(g, t)


# ---- F: derived features ----------------------------------------------------

@register("f1_age_years_diff", P_CLEAN + "SELECT ID_VICTIMA, EDAD FROM measures")
def f1(spark, sf):
    return measures(spark, sf).select(S.ID, "EDAD")


@register("f1_age_years_unfiltered", P_CLEAN + """SELECT ID_VICTIMA,
  CAST(year(FECHA_DESAPARICION_DT) - year(FECHA_NACIMIENTO_DT) AS BIGINT) AS EDAD FROM general""")
def f1u(spark, sf):
    return FE.age_years_diff(general(spark, sf), None, None).select(S.ID, "EDAD")


@register("f2_delay_days", P_CLEAN + "SELECT ID_VICTIMA, DIAS_REGISTRO FROM measures")
def f2(spark, sf):
    return measures(spark, sf).select(S.ID, "DIAS_REGISTRO")


@register("f3_age_fractional", P_MIN + "SELECT ID_VICTIMA, round(EDAD_FRAC, 6) AS EDAD_FRAC FROM mining")
def f3(spark, sf):
    return mining(spark, sf).select(S.ID, r6(F.col("EDAD_FRAC")).alias("EDAD_FRAC"))


_DAYS = "floor((epoch({b}) - epoch({a})) / 86400)"


@register("f4_age_floor_imputed", O.with_ctes(O.REGISTRY, O.CLEAN, f"""
x AS (SELECT ID_VICTIMA, CAST(floor({_DAYS.format(a='FECHA_NACIMIENTO_DT', b='FECHA_DESAPARICION_DT')} / 365)
      AS DOUBLE) AS a FROM general)""") + "SELECT ID_VICTIMA, coalesce(a, (SELECT median(a) FROM x)) AS EDAD FROM x")
def f4(spark, sf):
    return FE.age_floor_imputed(general(spark, sf)).select(S.ID, "EDAD")


@register("f5_delay_imputed", O.with_ctes(O.REGISTRY, O.CLEAN, f"""
x AS (SELECT ID_VICTIMA, CAST({_DAYS.format(a='FECHA_DESAPARICION_DT', b='FECHA_REGISTRO_DT')} AS DOUBLE) AS d
      FROM general)""") + "SELECT ID_VICTIMA, coalesce(d, (SELECT median(d) FROM x)) AS RETRASO_REGISTRO FROM x")
def f5(spark, sf):
    return FE.delay_imputed(general(spark, sf)).select(S.ID, "RETRASO_REGISTRO")


@register("f6_age_band", P_MIN + "SELECT ID_VICTIMA, GRUPO_EDAD FROM mining")
def f6(spark, sf):
    return mining(spark, sf).select(S.ID, "GRUPO_EDAD")


@register("f7_term_band", P_MIN + "SELECT ID_VICTIMA, SEXENIO_DESAPARICION, SEXENIO_REGISTRO FROM mining")
def f7(spark, sf):
    return mining(spark, sf).select(S.ID, "SEXENIO_DESAPARICION", "SEXENIO_REGISTRO")


_YEARS = list(range(1995, 2003))


@register("f7_term_band_yearly", P_MIN + "SELECT ID_VICTIMA, CASE WHEN DIS_DT IS NULL THEN 'DESCONOCIDO' "
          + " ".join(f"WHEN year(DIS_DT) >= {y} AND year(DIS_DT) < {y + 1} THEN '{y}'" for y in _YEARS[:-1])
          + " ELSE 'DESCONOCIDO' END AS BANDA FROM mining")
def f7y(spark, sf):
    return FE.term_band(mining(spark, sf), S.DISAPPEARED + "_DT", "BANDA", _YEARS,
                        [str(y) for y in _YEARS[:-1]]).select(S.ID, "BANDA")


@register("f8_month_item", P_MIN + "SELECT ID_VICTIMA, MES_DESAPARICION FROM mining")
def f8(spark, sf):
    return mining(spark, sf).select(S.ID, "MES_DESAPARICION")


@register("f9_year_item", P_MIN + """SELECT ID_VICTIMA,
  coalesce(CAST(year(DIS_DT) AS VARCHAR), 'DESCONOCIDO') AS ANIO_DESAPARICION,
  coalesce(CAST(year(REG_DT) AS VARCHAR), 'DESCONOCIDO') AS ANIO_REGISTRO FROM mining""")
def f9(spark, sf):
    return FE.mining_table(raw(spark, sf), years=True).select(S.ID, "ANIO_DESAPARICION", "ANIO_REGISTRO")


@register("f10_delay_scales", P_CLEAN + """SELECT ID_VICTIMA, DIAS_REGISTRO,
  round(DIAS_REGISTRO / 30.0, 6) AS MESES_REGISTRO, round(DIAS_REGISTRO / 365.0, 6) AS ANIOS_REGISTRO
FROM measures WHERE DIAS_REGISTRO IS NOT NULL""")
def f10(spark, sf):
    m = FE.delay_scales(measures(spark, sf).where(F.col("DIAS_REGISTRO").isNotNull()))
    return m.select(S.ID, "DIAS_REGISTRO", r6(F.col("MESES_REGISTRO")).alias("MESES_REGISTRO"),
                    r6(F.col("ANIOS_REGISTRO")).alias("ANIOS_REGISTRO"))


@register("f11_exclude_sentinel", P_MIN + "SELECT ID_VICTIMA FROM mining")
def f11(spark, sf):
    return FE.exclude_sentinel(raw(spark, sf)).select(S.ID)


# ---- G: descriptive statistics -----------------------------------------------

_MODE_COLS = [S.SEX, S.STATE, S.STATUS, S.SOURCE]


@register("g1_mode_table", O.with_ctes(O.REGISTRY, O.CLEAN, "stk AS (" + _cols_sql(
    _MODE_COLS, "SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS value FROM general") + ")", """
cnt AS (SELECT variable, value, count(*) AS n FROM stk WHERE value IS NOT NULL GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY variable ORDER BY n DESC, value) AS rn FROM cnt)""") + """
SELECT variable, value AS mode, n AS count, round(n * 100.0 / (SELECT count(*) FROM general), 6) AS pct
FROM rk WHERE rn = 1""")
def g1(spark, sf):
    return G.mode_table(general(spark, sf), _MODE_COLS)


def _loc_sql(c):
    return (f"SELECT '{c}' AS variable, count({c}) AS n, round(avg({c}), 6) AS mean, "
            f"round(median({c}), 6) AS median FROM measures")


@register("g2_location_stats", P_CLEAN + _loc_sql("EDAD") + " UNION ALL " + _loc_sql("DIAS_REGISTRO"))
def g2(spark, sf):
    m = measures(spark, sf)
    return G.location_stats(m, "EDAD").unionByName(G.location_stats(m, "DIAS_REGISTRO"))


@register("g3_delay_summary", P_CLEAN + """SELECT count(*) AS n, round(median(DIAS_REGISTRO), 6) AS median,
  round(avg(DIAS_REGISTRO), 6) AS mean, max(DIAS_REGISTRO) AS max_days, round(max(DIAS_REGISTRO) / 365.0, 6) AS max_years,
  round(count_if(DIAS_REGISTRO = 0) / count(*), 6) AS same_day_share FROM measures WHERE DIAS_REGISTRO IS NOT NULL""")
def g3(spark, sf):
    return G.delay_summary(measures(spark, sf))


def _spread_sql(c, src="measures"):
    return (f"SELECT '{c}' AS variable, round(CAST(max({c}) - min({c}) AS DOUBLE), 6) AS range, "
            f"round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.75), 6) AS q3, "
            f"round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 6) AS iqr, "
            f"round(var_samp({c}), 6) AS variance, round(stddev_samp({c}), 6) AS std FROM {src}")


@register("g4_spread_stats", P_CLEAN + _spread_sql("EDAD") + " UNION ALL " + _spread_sql("DIAS_REGISTRO"))
def g4(spark, sf):
    m = measures(spark, sf)
    return G.spread_stats(m, "EDAD").unionByName(G.spread_stats(m, "DIAS_REGISTRO"))


@register("g5_variance", P_CLEAN + """SELECT 'EDAD' AS variable, round(var_samp(EDAD), 6) AS variance,
  round(stddev_samp(EDAD), 6) AS std FROM measures""")
def g5(spark, sf):
    return G.spread_stats(measures(spark, sf), "EDAD").select("variable", "variance", "std")


@register("g6_compare_spread", P_CLEAN + """
SELECT dataset, count(x) AS n, round(CAST(max(x) - min(x) AS DOUBLE), 6) AS range,
  round(quantile_cont(x, 0.75) - quantile_cont(x, 0.25), 6) AS iqr, round(var_samp(x), 6) AS variance,
  round(stddev_samp(x), 6) AS std FROM (
  SELECT 'general' AS dataset, year(FECHA_DESAPARICION_DT) - year(FECHA_NACIMIENTO_DT) AS x FROM general
  UNION ALL SELECT 'temporal', EDAD FROM measures) GROUP BY dataset""")
def g6(spark, sf):
    gen = FE.age_years_diff(general(spark, sf), None, None)
    return G.compare_spread({"general": gen, "temporal": measures(spark, sf)}, "EDAD")


@register("g7_box_stats", O.with_ctes(O.REGISTRY, O.CLEAN, """
b AS (SELECT CAST(EDAD AS DOUBLE) AS x FROM measures WHERE EDAD IS NOT NULL),
p AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS med, quantile_cont(x, 0.75) AS q3,
             avg(x) AS mean FROM b),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM p)""") + """
SELECT count(*) AS n, round(any_value(q1), 6) AS q1, round(any_value(med), 6) AS median, round(any_value(q3), 6) AS q3,
  round(any_value(q3) - any_value(q1), 6) AS iqr, round(any_value(lo), 6) AS lo_fence, round(any_value(hi), 6) AS hi_fence,
  round(min(CASE WHEN x BETWEEN lo AND hi THEN x END), 6) AS whisker_low,
  round(max(CASE WHEN x BETWEEN lo AND hi THEN x END), 6) AS whisker_high,
  round(any_value(mean), 6) AS mean, count_if(NOT (x BETWEEN lo AND hi)) AS outliers FROM b, f""")
def g7(spark, sf):
    return G.box_stats(measures(spark, sf), "EDAD")


@register("g7_box_stats_datasets", O.with_ctes(O.REGISTRY, O.CLEAN, """
b AS (SELECT 'general' AS dataset, CAST(year(FECHA_DESAPARICION_DT) - year(FECHA_NACIMIENTO_DT) AS DOUBLE) AS x
      FROM general WHERE year(FECHA_DESAPARICION_DT) - year(FECHA_NACIMIENTO_DT) IS NOT NULL
      UNION ALL SELECT 'temporal', CAST(EDAD AS DOUBLE) FROM measures WHERE EDAD IS NOT NULL),
p AS (SELECT dataset, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS med, quantile_cont(x, 0.75) AS q3,
             avg(x) AS mean FROM b GROUP BY dataset),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM p)""") + """
SELECT dataset, count(*) AS n, round(any_value(q1), 6) AS q1, round(any_value(med), 6) AS median,
  round(any_value(q3), 6) AS q3, round(any_value(q3) - any_value(q1), 6) AS iqr,
  round(any_value(lo), 6) AS lo_fence, round(any_value(hi), 6) AS hi_fence,
  round(min(CASE WHEN x BETWEEN lo AND hi THEN x END), 6) AS whisker_low,
  round(max(CASE WHEN x BETWEEN lo AND hi THEN x END), 6) AS whisker_high,
  round(any_value(mean), 6) AS mean, count_if(NOT (x BETWEEN lo AND hi)) AS outliers
FROM b JOIN f USING (dataset) GROUP BY dataset""")
def g7d(spark, sf):
    """G7 of two datasets side by side."""
    gen = FE.age_years_diff(general(spark, sf), None, None).select(F.lit("general").alias("dataset"), "EDAD")
    tmp = measures(spark, sf).select(F.lit("temporal").alias("dataset"), "EDAD")
    return G.box_stats(gen.unionByName(tmp), "EDAD", by="dataset")


def _hist_sql(col, bins, cap=None):
    where = f"{col} IS NOT NULL" + (f" AND {col} <= {cap}" if cap is not None else "")
    return O.with_ctes(O.REGISTRY, O.CLEAN, f"""
hb AS (SELECT CAST({col} AS DOUBLE) AS x FROM measures WHERE {where}),
hr AS (SELECT min(x) AS mn, max(x) AS mx, count(*) AS n, (max(x) - min(x)) / {float(bins)} AS w FROM hb),
hh AS (SELECT CAST(CASE WHEN w = 0 THEN 0 ELSE least(floor((x - mn) / w), {bins - 1}) END AS BIGINT) AS bin,
              count(*) AS count FROM hb, hr GROUP BY 1)""") + f"""
SELECT bin, round(mn + bin * w, 6) AS lo, round(mn + (bin + 1) * w, 6) AS hi, count,
  round(count / (n * CASE WHEN w = 0 THEN 1.0 ELSE w END), 6) AS density FROM hh, hr"""


@register("g8_histogram", _hist_sql("EDAD", 60))
def g8(spark, sf):
    return G.histogram(measures(spark, sf), "EDAD", 60, density=True)


@register("g8_histogram_delay", _hist_sql("DIAS_REGISTRO", 80, 200))
def g8d(spark, sf):
    return G.histogram(measures(spark, sf), "DIAS_REGISTRO", 80, density=True, cap=200)


@register("g9_kde", O.with_ctes(O.REGISTRY, O.CLEAN, """
kb AS (SELECT CAST(EDAD AS DOUBLE) AS x FROM measures WHERE EDAD IS NOT NULL),
kv AS (SELECT x AS v, count(*) AS c FROM kb GROUP BY 1),
ks AS (SELECT count(*) AS n, stddev_samp(x) * pow(count(*), -0.2) AS bw, min(x) AS mn, max(x) AS mx FROM kb),
kg AS (SELECT g, mn - 3.0 * bw + g * ((mx - mn + 6.0 * bw) / 199.0) AS gx FROM ks, range(0, 200) t(g))""") + """
SELECT CAST(kg.g AS BIGINT) AS point, round(any_value(kg.gx), 6) AS x,
  round(sum(kv.c * exp(-0.5 * ((kg.gx - kv.v) / ks.bw) * ((kg.gx - kv.v) / ks.bw)))
        / (any_value(ks.n) * any_value(ks.bw) * sqrt(2 * pi())), 6) AS density
FROM kg, kv, ks GROUP BY kg.g""")
def g9(spark, sf):
    return G.kde(measures(spark, sf), "EDAD")


@register("g10_sigma_band", O.with_ctes(O.REGISTRY, O.CLEAN, """
sb AS (SELECT EDAD AS x FROM measures WHERE EDAD IS NOT NULL),
st AS (SELECT avg(x) AS m, stddev_samp(x) AS s FROM sb)""") + """
SELECT count(*) AS n, round(any_value(m), 6) AS mean, round(any_value(s), 6) AS std, round(any_value(m - s), 6) AS low,
  round(any_value(m + s), 6) AS high, count_if(x BETWEEN m - s AND m + s) AS inside,
  round(count_if(x BETWEEN m - s AND m + s) / count(*), 6) AS share FROM sb, st""")
def g10(spark, sf):
    return G.sigma_band(measures(spark, sf), "EDAD")


@register("g11_category_share", P_CLEAN + """SELECT SEXO AS value, count(*) AS count,
  round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct FROM general WHERE SEXO IS NOT NULL GROUP BY 1""")
def g11(spark, sf):
    return G.category_share(general(spark, sf), S.SEX)


@register("g12_top_categories", P_CLEAN + """SELECT ENTIDAD AS value, count(*) AS count FROM general
WHERE ENTIDAD IS NOT NULL GROUP BY 1 ORDER BY count DESC, value LIMIT 10""")
def g12(spark, sf):
    return G.top_categories(general(spark, sf), S.STATE, 10)


_DIV = O.with_ctes(O.REGISTRY, O.CLEAN, """
dv AS (SELECT ENTIDAD AS value, count(*) AS c FROM general
       WHERE ENTIDAD IS NOT NULL AND ENTIDAD <> 'SE DESCONOCE' GROUP BY 1),
dt AS (SELECT sum(c) AS n, count(*) AS k, sum(c * c) AS ss, sum(c * log2(c)) AS clc FROM dv)""")


@register("g13_gini_impurity", _DIV + """SELECT 'ENTIDAD' AS variable,
  round(sum((c / n) * (1 - c / n)), 6) AS gini FROM dv, dt""")
def g13(spark, sf):
    return G.gini_impurity(general(spark, sf), S.STATE, [S.UNKNOWN])


@register("g14_shannon_entropy", _DIV + """SELECT 'ENTIDAD' AS variable,
  round(-sum((c / n) * log2(c / n)), 6) AS entropy FROM dv, dt""")
def g14(spark, sf):
    return G.shannon_entropy(general(spark, sf), S.STATE, [S.UNKNOWN])


@register("g15_pielou_evenness", _DIV + """SELECT 'ENTIDAD' AS variable,
  round(CASE WHEN any_value(k) > 1 THEN -sum((c / n) * log2(c / n)) / log2(any_value(k)) ELSE 0.0 END, 6) AS evenness
  FROM dv, dt""")
def g15(spark, sf):
    return G.pielou_evenness(general(spark, sf), S.STATE, [S.UNKNOWN])


@register("g16_proportion_vs_uniform", _DIV + """SELECT value, c AS count, round(c / n, 6) AS proportion,
  round(1.0 / k, 6) AS uniform,
  CASE WHEN c / n > 1.0 / k THEN 'SOBRE' WHEN c / n < 1.0 / k THEN 'BAJO' ELSE 'IGUAL' END AS position FROM dv, dt""")
def g16(spark, sf):
    return G.proportion_vs_uniform(general(spark, sf), S.STATE, [S.UNKNOWN])


# record by record: sorted values and cumulative sums, no grouped closed form
_CONC = O.with_ctes(O.REGISTRY, O.CLEAN, """
cr AS (SELECT CAST(DIAS_REGISTRO AS DOUBLE) AS v FROM measures WHERE DIAS_REGISTRO IS NOT NULL),
ct AS (SELECT count(*) AS N, sum(v) AS S FROM cr),
ca AS (SELECT v, row_number() OVER w AS i, sum(v) OVER w AS cum FROM cr
       WINDOW w AS (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
cq AS (SELECT i, i / N AS p, cum / S AS q, lag(cum / S) OVER (ORDER BY i) AS q0, N, S FROM ca, ct WHERE S <> 0)""")


@register("g17_concentration_index", _CONC + """SELECT 'DIAS_REGISTRO' AS variable, (SELECT N FROM ct) AS n,
  round((SELECT sum(p - q) / sum(p) FROM cq WHERE i < N), 6) AS r""")
def g17(spark, sf):
    return C.concentration_index(measures(spark, sf), "DIAS_REGISTRO")


@register("g18_lorenz_curve", _CONC + """SELECT 0.0::DOUBLE AS f, 0.0::DOUBLE AS q UNION ALL
SELECT round(max(i) / any_value(N), 6), round(max(cum) / any_value(S), 6) FROM ca, ct GROUP BY v""")
def g18(spark, sf):
    return C.lorenz_curve(measures(spark, sf), "DIAS_REGISTRO")


@register("g19_concentration_trapezoid", _CONC + """SELECT 'DIAS_REGISTRO' AS variable, (SELECT N FROM ct) AS n,
  round((SELECT 1.0 - 2.0 * sum((q + q0) / 2.0 / N) FROM cq WHERE i > 1), 6) AS r""")
def g19(spark, sf):
    return C.concentration_trapezoid(measures(spark, sf), "DIAS_REGISTRO")


_WH = "greatest(confidencial_con_estado, confidencial_sin_estado)"


@register("g20_withheld_share_by", P_CLEAN + f"""
SELECT ENTIDAD, CAST(sum({_WH}) AS BIGINT) AS withheld, count(*) AS n,
  round(round(sum({_WH}) * 100.0 / count(*), 1), 6) AS pct,
  round((SELECT avg({_WH}) * 100 FROM general), 6) AS national_pct
FROM general GROUP BY ENTIDAD ORDER BY pct DESC, ENTIDAD LIMIT 15""")
def g20(spark, sf):
    return G.withheld_share_by(B2.withheld_total(general(spark, sf)), S.STATE)


# ---- H, K1, K7: correlation ------------------------------------------------

_SEXV = ["HOMBRE", "INDETERMINADO", "MUJER"]


def corr_input(spark, sf):
    return H.dummies(measures(spark, sf), S.SEX, "SEXO", _SEXV)


_CORR_COLS = ["EDAD", "DIAS_REGISTRO"] + [f"SEXO_{v}" for v in _SEXV]
_CI = O.with_ctes(O.REGISTRY, O.CLEAN, "ci AS (SELECT *, " + ", ".join(
    f"coalesce(CAST(SEXO = '{v}' AS INTEGER), 0) AS SEXO_{v}" for v in _SEXV) + " FROM measures)")


@register("h1_dummies", _CI + "SELECT ID_VICTIMA, " + ", ".join(f"SEXO_{v}" for v in _SEXV) + " FROM ci")
def h1(spark, sf):
    return corr_input(spark, sf).select(S.ID, *[f"SEXO_{v}" for v in _SEXV])


def _pairs(cols):
    from itertools import combinations
    return [(a, a) for a in cols] + list(combinations(cols, 2))


def _pearson_sql(a, b, src="ci"):
    x = f"CASE WHEN {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
    y = f"CASE WHEN {a} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
    return (f"SELECT '{a}' AS var_a, '{b}' AS var_b, count({x}) AS n, "
            f"round(covar_samp({x}, {y}) / nullif(stddev_samp({x}) * stddev_samp({y}), 0), 6) AS r FROM {src}")


_H2_SQL = " UNION ALL ".join(_pearson_sql(a, b) for a, b in _pairs(_CORR_COLS))


@register("h2_pearson_matrix", _CI + _H2_SQL)
def h2(spark, sf):
    return H.pearson_matrix(corr_input(spark, sf), _CORR_COLS)


@register("h3_flag_category_correlation", O.with_ctes(O.REGISTRY, O.CLEAN, f"""
hg AS (SELECT ORIGEN_REPORTE AS o, {_WH} AS ct FROM general),
hc AS (SELECT o AS category, count(*) AS n FROM hg WHERE o IS NOT NULL GROUP BY 1)""") + """
SELECT category, any_value(n) AS n,
  round(CASE WHEN stddev_pop(ct) > 0 AND stddev_pop(CAST(o IS NOT DISTINCT FROM category AS INTEGER)) > 0
        THEN corr(ct, CAST(o IS NOT DISTINCT FROM category AS INTEGER)) END, 6) AS r FROM hg, hc GROUP BY category""")
def h3(spark, sf):
    return H.flag_category_correlation(B2.withheld_total(general(spark, sf)), "confidencial_total", S.SOURCE)


@register("h4_withheld_total", P_CLEAN + f"SELECT ID_VICTIMA, {_WH} AS confidencial_total FROM general")
def h4(spark, sf):
    return B2.withheld_total(general(spark, sf)).select(S.ID, "confidencial_total")


@register("h5_correlation_strength", _CI + "SELECT *, CASE WHEN r IS NULL THEN NULL WHEN abs(r) < 0.30 THEN 'debil' "
          "WHEN abs(r) < 0.50 THEN 'moderada' ELSE 'fuerte' END AS strength FROM (" + _H2_SQL + ")")
def h5(spark, sf):
    return H.correlation_strength(H.pearson_matrix(corr_input(spark, sf), _CORR_COLS))


def _spearman_sql(a, b):
    sub = (f"SELECT CAST({a} AS DOUBLE) AS xa, CAST({b} AS DOUBLE) AS xb FROM ci "
           f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL")
    rk = (f"SELECT rank() OVER (ORDER BY xa) + (count(*) OVER (PARTITION BY xa) - 1) / 2.0 AS ra, "
          f"rank() OVER (ORDER BY xb) + (count(*) OVER (PARTITION BY xb) - 1) / 2.0 AS rb FROM ({sub})")
    return (f"SELECT '{a}' AS var_a, '{b}' AS var_b, count(ra) AS n, "
            f"round(covar_samp(ra, rb) / nullif(stddev_samp(ra) * stddev_samp(rb), 0), 6) AS r FROM ({rk})")


@register("k1_spearman_matrix", _CI + " UNION ALL ".join(_spearman_sql(a, b) for a, b in _pairs(_CORR_COLS)))
def k1(spark, sf):
    return H.spearman_matrix(corr_input(spark, sf), _CORR_COLS)


@register("k2_shape_stats", P_CLEAN + """SELECT 'EDAD' AS variable, count(EDAD) AS n,
  round(skewness(EDAD), 6) AS skewness, round(kurtosis(EDAD), 6) AS kurtosis FROM measures""")
def k2(spark, sf):
    return G.shape_stats(measures(spark, sf), "EDAD")


@register("k7_numeric_category_correlation", O.with_ctes(O.REGISTRY, O.CLEAN, """
kb AS (SELECT ENTIDAD AS o, CAST(DIAS_REGISTRO AS DOUBLE) AS x FROM measures WHERE DIAS_REGISTRO IS NOT NULL),
kc AS (SELECT o AS category, count(*) AS n FROM kb WHERE o IS NOT NULL GROUP BY 1)""") + """
SELECT category, any_value(n) AS n,
  round(CASE WHEN stddev_pop(x) > 0 AND stddev_pop(CAST(o IS NOT DISTINCT FROM category AS INTEGER)) > 0
        THEN corr(x, CAST(o IS NOT DISTINCT FROM category AS INTEGER)) END, 6) AS r FROM kb, kc GROUP BY category""")
def k7(spark, sf):
    return H.numeric_category_correlation(measures(spark, sf), "DIAS_REGISTRO", S.STATE)


# ---- K: anomalies and published counts ----------------------------------------

_COMP = "FECHA_DESAPARICION_DT IS NOT NULL AND FECHA_REGISTRO_DT IS NOT NULL"


@register("k3_anomaly_concentration", O.with_ctes(O.REGISTRY, O.CLEAN, f"""
ag AS (SELECT ORIGEN_REPORTE, sum(flag_registro_antes_desaparicion) AS a, count(*) AS c FROM temporal
       WHERE {_COMP} GROUP BY 1),
top AS (SELECT * FROM ag ORDER BY a DESC, ORIGEN_REPORTE LIMIT 5)""") + """
SELECT CAST(5 AS BIGINT) AS k, CAST(sum(a) AS BIGINT) AS anomalies,
  round(sum(a) * 100.0 / (SELECT sum(a) FROM ag), 6) AS anomaly_share,
  round(sum(c) * 100.0 / (SELECT sum(c) FROM ag), 6) AS row_share FROM top""")
def k3(spark, sf):
    return K.anomaly_concentration(temporal(spark, sf), 5)


@register("k4_anomaly_buckets", P_CLEAN + """
SELECT CASE WHEN s <= 86400 THEN 'a) <= 1 dia' WHEN s <= 7 * 86400 THEN 'b) 1-7 dias'
            WHEN s <= 30 * 86400 THEN 'c) 7-30 dias' WHEN s <= 365 * 86400 THEN 'd) 30-365 dias'
            ELSE 'e) > 1 anio' END AS bucket, count(*) AS count
FROM (SELECT epoch(FECHA_DESAPARICION_DT) - epoch(FECHA_REGISTRO_DT) AS s FROM temporal
      WHERE flag_registro_antes_desaparicion = 1) GROUP BY 1""")
def k4(spark, sf):
    return K.anomaly_buckets(temporal(spark, sf))


@register("k5_anomaly_rate", P_CLEAN + f"""SELECT count_if(flag_registro_antes_desaparicion = 1) AS anomalies,
  count_if({_COMP}) AS computable,
  round(count_if(flag_registro_antes_desaparicion = 1) * 100.0 / count_if({_COMP}), 6) AS pct FROM temporal""")
def k5(spark, sf):
    return K.anomaly_rate(temporal(spark, sf))


@register("k6_records_by_term", P_MIN + "SELECT SEXENIO_DESAPARICION AS term, count(*) AS count FROM mining GROUP BY 1")
def k6(spark, sf):
    return K.records_by_term(mining(spark, sf))


@register("k8_trend_year", P_CLEAN + """SELECT strftime(FECHA_DESAPARICION_DT, '%Y') AS period, count(*) AS count
FROM general GROUP BY 1""")
def k8(spark, sf):
    return K.trend(general(spark, sf), "year")


@register("k8_trend_month", P_CLEAN + """SELECT strftime(FECHA_DESAPARICION_DT, '%Y-%m') AS period, count(*) AS count
FROM general GROUP BY 1""")
def k8m(spark, sf):
    return K.trend(general(spark, sf), "month")


@register("k9_source_by_state", P_CLEAN + """SELECT ORIGEN_REPORTE, ENTIDAD, count(*) AS count FROM general
GROUP BY 1, 2""")
def k9(spark, sf):
    return K.source_by_state(general(spark, sf))


# ---- I: association mining -------------------------------------------------------

def _itemsets_sql(cols):
    return f"""
{O.tx_items(cols)},
ntx AS (SELECT count(*) AS n FROM mining),
thr AS (SELECT CAST(ceil(0.02 * CAST(n AS DOUBLE)) AS BIGINT) AS m, CAST(n AS DOUBLE) AS n FROM ntx),
f1 AS (SELECT item AS i1, count(*) AS freq FROM tx_items GROUP BY item HAVING count(*) >= (SELECT m FROM thr)),
t1 AS (SELECT t.tx_id, t.item FROM tx_items t JOIN f1 ON t.item = f1.i1),
f2 AS (SELECT a.item AS i1, b.item AS i2, count(*) AS freq FROM t1 a JOIN t1 b
       ON a.tx_id = b.tx_id AND a.item < b.item GROUP BY 1, 2 HAVING count(*) >= (SELECT m FROM thr)),
f3 AS (SELECT a.item AS i1, b.item AS i2, c.item AS i3, count(*) AS freq FROM t1 a
       JOIN t1 b ON a.tx_id = b.tx_id AND a.item < b.item JOIN t1 c ON a.tx_id = c.tx_id AND b.item < c.item
       GROUP BY 1, 2, 3 HAVING count(*) >= (SELECT m FROM thr)),
itemsets AS (SELECT 1 AS k, i1 AS itemset, freq FROM f1
  UNION ALL SELECT 2, i1 || ', ' || i2, freq FROM f2
  UNION ALL SELECT 3, i1 || ', ' || i2 || ', ' || i3, freq FROM f3),
c3raw AS (SELECT a.i1, a.i2, b.i2 AS i3 FROM f2 a JOIN f2 b ON a.i1 = b.i1 AND a.i2 < b.i2),
c3 AS (SELECT r.* FROM c3raw r JOIN f2 s ON s.i1 = r.i2 AND s.i2 = r.i3),
rr AS (
  SELECT f2.i1 AS ante, f2.i2 AS cons, 1 AS nc, f2.freq, a.freq AS fa, c.freq AS fc
    FROM f2 JOIN f1 a ON a.i1 = f2.i1 JOIN f1 c ON c.i1 = f2.i2
  UNION ALL SELECT f2.i2, f2.i1, 1, f2.freq, a.freq, c.freq
    FROM f2 JOIN f1 a ON a.i1 = f2.i2 JOIN f1 c ON c.i1 = f2.i1
  UNION ALL SELECT f3.i1, f3.i2 || ', ' || f3.i3, 2, f3.freq, a.freq, c.freq
    FROM f3 JOIN f1 a ON a.i1 = f3.i1 JOIN f2 c ON c.i1 = f3.i2 AND c.i2 = f3.i3
  UNION ALL SELECT f3.i2, f3.i1 || ', ' || f3.i3, 2, f3.freq, a.freq, c.freq
    FROM f3 JOIN f1 a ON a.i1 = f3.i2 JOIN f2 c ON c.i1 = f3.i1 AND c.i2 = f3.i3
  UNION ALL SELECT f3.i3, f3.i1 || ', ' || f3.i2, 2, f3.freq, a.freq, c.freq
    FROM f3 JOIN f1 a ON a.i1 = f3.i3 JOIN f2 c ON c.i1 = f3.i1 AND c.i2 = f3.i2
  UNION ALL SELECT f3.i1 || ', ' || f3.i2, f3.i3, 1, f3.freq, a.freq, c.freq
    FROM f3 JOIN f2 a ON a.i1 = f3.i1 AND a.i2 = f3.i2 JOIN f1 c ON c.i1 = f3.i3
  UNION ALL SELECT f3.i1 || ', ' || f3.i3, f3.i2, 1, f3.freq, a.freq, c.freq
    FROM f3 JOIN f2 a ON a.i1 = f3.i1 AND a.i2 = f3.i3 JOIN f1 c ON c.i1 = f3.i2
  UNION ALL SELECT f3.i2 || ', ' || f3.i3, f3.i1, 1, f3.freq, a.freq, c.freq
    FROM f3 JOIN f2 a ON a.i1 = f3.i2 AND a.i2 = f3.i3 JOIN f1 c ON c.i1 = f3.i1),
rules AS (
  SELECT ante AS antecedents, cons AS consequents, nc, freq / n AS support, freq / fa AS confidence,
         (freq / fa) / (fc / n) AS lift FROM rr, thr WHERE freq / fa >= 0.70)"""


P_ITEMS = O.with_ctes(O.REGISTRY, O.MINING, _itemsets_sql(O.ITEM_COLS))
P_ITEMS_YEARS = O.with_ctes(O.REGISTRY, O.MINING, _itemsets_sql(O.ITEM_COLS_YEARS))
_RULE_COLS = ("antecedents, consequents, round(support, 6) AS support, round(confidence, 6) AS confidence, "
              "round(lift, 6) AS lift")
_TRIVIAL = "(consequents LIKE '%ENTIDAD%' OR antecedents LIKE '%SE DESCONOCE%' OR consequents LIKE '%SE DESCONOCE%')"


def _itemset_out(df):
    return df.select(F.col("k").cast("int").alias("k"),
                     F.array_join(F.array_sort("items"), ", ").alias("itemset"),
                     F.col("freq").cast("long").alias("freq"), r6(F.col("support")).alias("support"))


_ITEMSET_SQL = P_ITEMS + "SELECT k, itemset, freq, round(freq / (SELECT n FROM thr), 6) AS support FROM itemsets"


@register("i1_to_transactions", O.with_ctes(O.REGISTRY, O.MINING, O.tx_items(O.ITEM_COLS)) + """
SELECT m.ID_VICTIMA AS tx_id, coalesce(string_agg(t.item, ', ' ORDER BY t.item), '') AS items
FROM mining m LEFT JOIN tx_items t ON t.tx_id = m.ID_VICTIMA GROUP BY m.ID_VICTIMA""")
def i1(spark, sf):
    return transactions(spark, sf).select("tx_id", F.array_join("items", ", ").alias("items"))


@register("i2_encode_transactions", P_ITEMS + "SELECT item, count(*) AS count FROM tx_items GROUP BY item")
def i2(spark, sf):
    return I.item_totals(*I.encode_transactions(transactions(spark, sf)))


@register("i3_frequent_items", P_ITEMS + "SELECT i1 AS item, freq FROM f1")
def i3(spark, sf):
    tx = transactions(spark, sf)
    m = I.min_count_for(0.02, tx.count())
    return I.frequent_items(tx, m).select(F.element_at("items", 1).alias("item"), "freq")


def _level(spark, sf, k):
    return mined(spark, sf).itemsets.where(F.col("k") == k)


@register("i4_generate_candidates", P_ITEMS + "SELECT i1 || ', ' || i2 || ', ' || i3 AS itemset FROM c3raw")
def i4(spark, sf):
    return I.generate_candidates(_level(spark, sf, 2), 3).select(
        F.array_join("items", ", ").alias("itemset"))


@register("i4_generate_candidates_k2", P_ITEMS + "SELECT a.i1 || ', ' || b.i1 AS itemset FROM f1 a JOIN f1 b "
          "ON a.i1 < b.i1")
def i4k2(spark, sf):
    return I.generate_candidates(_level(spark, sf, 1), 2).select(
        F.array_join("items", ", ").alias("itemset"))


@register("i5_prune_candidates", P_ITEMS + "SELECT i1 || ', ' || i2 || ', ' || i3 AS itemset FROM c3")
def i5(spark, sf):
    f2 = _level(spark, sf, 2)
    return I.prune_candidates(I.generate_candidates(f2, 3), f2, 3).select(
        F.array_join("items", ", ").alias("itemset"))


@register("i6_count_support", P_ITEMS + "SELECT i1 || ', ' || i2 AS itemset, freq FROM f2")
def i6(spark, sf):
    """Support of all candidate pairs, counted on the item texts themselves."""
    tx = I._checkpoint(transactions(spark, sf).select("items"))
    m = I.min_count_for(0.02, tx.count())
    cand = I.generate_candidates(I.frequent_items(tx, m), 2)
    return I.count_support(tx, cand, 2, m).select(F.array_join("items", ", ").alias("itemset"), "freq")


@register("i7_apriori", _ITEMSET_SQL)
def i7(spark, sf):
    return _itemset_out(mined(spark, sf).itemsets)


@register("i8_apriori_bitmaps", _ITEMSET_SQL)
def i8(spark, sf):
    """Apriori on vertical bitmaps."""
    return _itemset_out(mined(spark, sf, "bitmaps").itemsets)


@register("i9_fp_growth", _ITEMSET_SQL)
def i9(spark, sf):
    return _itemset_out(mined(spark, sf, "fpgrowth").itemsets)


@register("i10_compare_itemsets", P_ITEMS + """SELECT CAST(0 AS BIGINT) AS only_a, CAST(0 AS BIGINT) AS only_b,
  count(*) AS common FROM itemsets""")
def i10(spark, sf):
    return I.compare_itemsets(mined(spark, sf).itemsets, mined(spark, sf, "fpgrowth").itemsets)


@register("i11_itemset_table", P_ITEMS + """SELECT itemset, CAST(k AS BIGINT) AS size, freq AS count,
  round(freq / (SELECT n FROM thr), 6) AS support FROM itemsets""")
def i11(spark, sf):
    return I.itemset_table(mined(spark, sf).itemsets)


@register("i12_level_stats", P_ITEMS + """
SELECT 1 AS k, CAST(NULL AS BIGINT) AS candidates, (SELECT count(*) FROM f1) AS frequent, CAST(NULL AS DOUBLE) AS pct_dropped
UNION ALL SELECT 2, c, f, round(100.0 * (c - f) / c, 6) FROM
  (SELECT (SELECT count(*) FROM f1) * ((SELECT count(*) FROM f1) - 1) // 2 AS c, (SELECT count(*) FROM f2) AS f)
UNION ALL SELECT 3, c, f, round(100.0 * (c - f) / c, 6) FROM
  (SELECT (SELECT count(*) FROM c3) AS c, (SELECT count(*) FROM f3) AS f)""")
def i12(spark, sf):
    return mined(spark, sf).levels


@register("i13_generate_rules", P_ITEMS + f"SELECT {_RULE_COLS} FROM rules")
def i13(spark, sf):
    return R.rule_text(rules(spark, sf))


@register("i14_single_consequent", P_ITEMS + f"SELECT {_RULE_COLS} FROM rules WHERE nc = 1")
def i14(spark, sf):
    return R.rule_text(R.single_consequent(rules(spark, sf)))


@register("i15_consequent_on", P_ITEMS + f"SELECT {_RULE_COLS} FROM rules WHERE nc = 1 AND consequents LIKE 'ENTIDAD%'")
def i15(spark, sf):
    return R.rule_text(R.consequent_on(R.single_consequent(rules(spark, sf)), "ENTIDAD"))


@register("i16_filter_rules", P_ITEMS + f"SELECT {_RULE_COLS} FROM rules WHERE lift >= 1.2")
def i16(spark, sf):
    return R.rule_text(R.filter_rules(rules(spark, sf), min_lift=1.2))


@register("i17_drop_trivial_rules", P_ITEMS + f"SELECT {_RULE_COLS} FROM rules WHERE lift >= 1.2 AND NOT {_TRIVIAL}")
def i17(spark, sf):
    return R.rule_text(R.drop_trivial_rules(R.filter_rules(rules(spark, sf), min_lift=1.2)))


@register("i18_interpret_lift", P_ITEMS + f"""SELECT {_RULE_COLS}, CASE WHEN lift > 1 THEN 'Asociación positiva'
  WHEN lift = 1 THEN 'Independencia' ELSE 'Asociación negativa' END AS interpretacion_lift FROM rules WHERE nc = 1""")
def i18(spark, sf):
    r = R.interpret_lift(R.single_consequent(rules(spark, sf)))
    return R.rule_text(r, extra=["interpretacion_lift"])


@register("i19_rule_funnel", P_ITEMS + f"""SELECT count(*) AS total, count_if(lift >= 1.2) AS lifted,
  count_if(lift >= 1.2 AND NOT {_TRIVIAL}) AS non_trivial FROM rules""")
def i19(spark, sf):
    return R.rule_funnel(rules(spark, sf))


def _pattern_sql(ant, cons):
    cond = " AND ".join([f"antecedents LIKE '%{a}%'" for a in ant] + [f"consequents LIKE '%{c}%'" for c in cons])
    return P_ITEMS + f"SELECT {_RULE_COLS} FROM rules WHERE lift >= 1.2" + (f" AND {cond}" if cond else "")


for _p, (_a, _c) in R.PATTERNS.items():
    def _mk(p):
        def q(spark, sf):
            return R.rule_text(R.pattern(rules(spark, sf), p))
        return q
    register(f"i20_pattern_{_p}", _pattern_sql(_a, _c))(_mk(_p))


@register("i21_max_lift_by_term", P_ITEMS + """
SELECT term, round(max(lift), 6) AS max_lift,
  array_to_string(list_sort(list_distinct(flatten(list(ages)))), ', ') AS age_groups FROM (
  SELECT regexp_extract(antecedents, 'SEXENIO_DESAPARICION=([^,]*)', 1) AS term,
         regexp_extract(consequents, 'SEXENIO_REGISTRO=([^,]*)', 1) AS term_r, lift,
         regexp_extract_all(antecedents || ', ' || consequents, 'GRUPO_EDAD=[^,]*') AS ages
  FROM rules WHERE lift >= 1.2 AND antecedents LIKE '%SEXENIO_DESAPARICION%' AND consequents LIKE '%SEXENIO_REGISTRO%')
WHERE term = term_r GROUP BY term""")
def i21(spark, sf):
    return R.max_lift_by_term(rules(spark, sf))


# ---- J: classification ------------------------------------------------------------

_FEATS = list(S.ITEM_COLUMNS)
_LABEL = S.STATUS


def model_table(spark, sf):
    return mining(spark, sf).select(S.ID, _LABEL, *_FEATS)


def split_table(spark, sf):
    """Stratified 80/20 split of the model table, written once per query: train
    and test parts, weights, encoders and reports all read the same copy."""
    return I._checkpoint(J.stratified_split(model_table(spark, sf), _LABEL, 0.2, 42, S.ID))


_SPLIT_SQL = O.with_ctes(O.REGISTRY, O.MINING, """
cls AS (SELECT ESTATUS_VICTIMA AS c, count(*) AS n FROM mining GROUP BY 1),
tot AS (SELECT CAST(sum(n) AS DOUBLE) AS nn, ceil(0.2 * CAST(sum(n) AS DOUBLE)) AS t FROM cls),
al AS (SELECT c, floor(t * n / nn) AS base, t * n / nn - floor(t * n / nn) AS frac FROM cls, tot),
alloc AS (SELECT c, base + CASE WHEN row_number() OVER (ORDER BY frac DESC, c)
                                   <= (SELECT any_value(t) FROM tot) - (SELECT sum(base) FROM al) THEN 1 ELSE 0 END AS take
          FROM al),
ranked AS (SELECT *, row_number() OVER (PARTITION BY ESTATUS_VICTIMA ORDER BY md5(ID_VICTIMA || '#42'), ID_VICTIMA) AS rn
           FROM mining),
splitted AS (SELECT r.*, CASE WHEN rn <= take THEN 'test' ELSE 'train' END AS split
             FROM ranked r JOIN alloc ON alloc.c = r.ESTATUS_VICTIMA)""")


@register("j1_label_encode", O.with_ctes(O.REGISTRY, O.MINING) + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", value, CAST(dense_rank() OVER (ORDER BY value) - 1 AS BIGINT) AS code "
    f"FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS value FROM mining WHERE {c} IS NOT NULL)" for c in _FEATS))
def j1(spark, sf):
    return J.label_codes(model_table(spark, sf), _FEATS)


@register("j2_class_distribution", P_MIN + """SELECT ESTATUS_VICTIMA, count(*) AS count,
  round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct FROM mining GROUP BY 1""")
def j2(spark, sf):
    return J.class_distribution(model_table(spark, sf), _LABEL)


@register("j2_class_distribution_split", _SPLIT_SQL + """SELECT split, ESTATUS_VICTIMA, count(*) AS count,
  round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY split), 6) AS pct FROM splitted GROUP BY 1, 2""")
def j2s(spark, sf):
    return J.class_distribution(split_table(spark, sf), _LABEL, J.SPLIT)


@register("j3_random_split", P_MIN + """SELECT split, count(*) AS count FROM (
  SELECT CASE WHEN row_number() OVER (ORDER BY md5(ID_VICTIMA || '#42'), ID_VICTIMA)
                   <= ceil(0.3 * CAST(count(*) OVER () AS DOUBLE)) THEN 'test' ELSE 'train' END AS split
  FROM mining) GROUP BY 1""")
def j3(spark, sf):
    return J.random_split(model_table(spark, sf), 0.3, 42, S.ID).groupBy(J.SPLIT).agg(
        F.count(F.lit(1)).alias("count"))


@register("j3_random_split_rows", P_MIN + """SELECT ID_VICTIMA,
  CASE WHEN row_number() OVER (ORDER BY md5(ID_VICTIMA || '#42'), ID_VICTIMA)
            <= ceil(0.3 * CAST(count(*) OVER () AS DOUBLE)) THEN 'test' ELSE 'train' END AS split FROM mining""")
def j3r(spark, sf):
    return J.random_split(model_table(spark, sf), 0.3, 42, S.ID).select(S.ID, J.SPLIT)


@register("j4_stratified_split", _SPLIT_SQL + "SELECT split, ESTATUS_VICTIMA, count(*) AS count FROM splitted GROUP BY 1, 2")
def j4(spark, sf):
    return split_table(spark, sf).groupBy(J.SPLIT, _LABEL).agg(F.count(F.lit(1)).alias("count"))


@register("j4_stratified_split_rows", _SPLIT_SQL + "SELECT ID_VICTIMA, split FROM splitted")
def j4r(spark, sf):
    return split_table(spark, sf).select(S.ID, J.SPLIT)


@register("j5_balanced_weights", _SPLIT_SQL + """SELECT ESTATUS_VICTIMA, count(*) AS count,
  round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight FROM splitted WHERE split = 'train'
  GROUP BY 1""")
def j5(spark, sf):
    return J.class_weights(split_table(spark, sf).where(F.col(J.SPLIT) == "train"), _LABEL)


def encoded_split(spark, sf, features=None, split=None):
    """The split table with its label codes, written once, and the code table:
    (rows, codes)."""
    enc, codes = J.label_encode(split or split_table(spark, sf), features or _FEATS)
    return I._checkpoint(enc), codes


def forest(spark, sf, features=None, encoded=None):
    """Forest on label-encoded item features with balanced weights."""
    feats = features or _FEATS
    enc, _ = encoded or encoded_split(spark, sf, feats)
    train = J.balanced_weights(enc.where(F.col(J.SPLIT) == "train"), _LABEL)
    model = J.train_forest(train, [c + "_idx" for c in feats], _LABEL, num_trees=100, max_depth=12, seed=42)
    return model, enc.where(F.col(J.SPLIT) == "test"), feats


@register("j6_train_forest")
def j6(spark, sf):
    model, _, feats = forest(spark, sf)
    return J.feature_importance(model, feats)


def _checked_importance(imp, codes):
    """What SQL can say about importances: the feature's number of codes, that
    each lies between 0 and 1, and their sum."""
    total = scalars(imp.agg(F.sum("importance").alias("t")))["t"]
    return imp.join(codes.groupBy(F.col("column").alias("feature")).agg(F.count(F.lit(1)).alias("codes")),
                    "feature").select("feature", "codes", F.col("importance").between(0, 1).alias("in_range"),
                                      r6(total).alias("total"))


def _codes_sql(feats):
    return _SPLIT_SQL + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(DISTINCT coalesce({c}, chr(1))) AS codes, TRUE AS in_range, "
        "CAST(1 AS DOUBLE) AS total FROM splitted" for c in feats)


@register("j6_forest_features", _codes_sql(_FEATS))
def j6c(spark, sf):
    encoded = encoded_split(spark, sf)
    model, _, feats = forest(spark, sf, encoded=encoded)
    return _checked_importance(J.feature_importance(model, feats), encoded[1])


@register("j7_predict")
def j7(spark, sf):
    model, test, _ = forest(spark, sf)
    return J.predict(model, test, _LABEL).select(S.ID, _LABEL, "predicted")


@register("j7_predict_rows", _SPLIT_SQL + """SELECT ID_VICTIMA, ESTATUS_VICTIMA, TRUE AS known
FROM splitted WHERE split = 'test'""")
def j7r(spark, sf):
    """Every test row gets one prediction, one of the training classes."""
    model, test, _ = forest(spark, sf)
    return J.predict(model, test, _LABEL).select(
        S.ID, _LABEL, F.coalesce(F.col("predicted").isin(*model.stages[0].labels), F.lit(False)).alias("known"))


@register("j8_forest_report")
def j8f(spark, sf):
    model, test, _ = forest(spark, sf)
    return J.classification_report(J.predict(model, test, _LABEL), _LABEL)


def _checked_report(rep):
    """What SQL can say about a forest's report: its classes, supports and
    that the scores lie between 0 and 1."""
    scores = [F.coalesce(F.col(c).between(0, 1), F.lit(True)) for c in ("precision", "recall", "f1")]
    return rep.select("class", "support", (scores[0] & scores[1] & scores[2]).alias("in_range"))


def _support_sql(test):
    return f"""SELECT ESTATUS_VICTIMA AS class, count(*) AS support, TRUE AS in_range FROM {test} GROUP BY 1
UNION ALL SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), (SELECT count(*) FROM {test}), TRUE"""


@register("j8_forest_supports", _SPLIT_SQL + ", tested AS (SELECT * FROM splitted WHERE split = 'test')\n"
          + _support_sql("tested"))
def j8fs(spark, sf):
    return _checked_report(j8f(spark, sf))


def _rule_pred(spark, sf, by=S.MUNI, split=None):
    st = split or split_table(spark, sf)
    return J.group_majority_predict(st.where(F.col(J.SPLIT) == "train"), st.where(F.col(J.SPLIT) == "test"),
                                    by, _LABEL)


_PRED_SQL = _SPLIT_SQL.rstrip() + """,
gm AS (SELECT MUNICIPIO, ESTATUS_VICTIMA, count(*) AS c FROM splitted WHERE split = 'train' GROUP BY 1, 2),
gb AS (SELECT MUNICIPIO, ESTATUS_VICTIMA AS p FROM (SELECT *, row_number() OVER (PARTITION BY MUNICIPIO
       ORDER BY c DESC, ESTATUS_VICTIMA) AS rn FROM gm) WHERE rn = 1),
ov AS (SELECT ESTATUS_VICTIMA AS p FROM splitted WHERE split = 'train' GROUP BY 1
       ORDER BY count(*) DESC, ESTATUS_VICTIMA LIMIT 1),
pred AS (SELECT s.ID_VICTIMA, s.ESTATUS_VICTIMA, coalesce(gb.p, (SELECT p FROM ov)) AS predicted
         FROM splitted s LEFT JOIN gb ON gb.MUNICIPIO = s.MUNICIPIO WHERE s.split = 'test'),
cm AS (SELECT ESTATUS_VICTIMA AS actual, predicted, count(*) AS count FROM pred GROUP BY 1, 2),
per AS (SELECT c AS class,
          coalesce((SELECT sum(count) FROM cm WHERE actual = c AND predicted = c), 0) AS tp,
          coalesce((SELECT sum(count) FROM cm WHERE actual = c), 0) AS support,
          coalesce((SELECT sum(count) FROM cm WHERE predicted = c), 0) AS npred
        FROM (SELECT actual AS c FROM cm UNION SELECT predicted FROM cm)),
pr AS (SELECT class, support, tp,
          coalesce(CAST(tp AS DOUBLE) / nullif(npred, 0), 0.0) AS precision,
          coalesce(CAST(tp AS DOUBLE) / nullif(support, 0), 0.0) AS recall FROM per),
pf AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM pr)
"""


@register("j8_classification_report", _PRED_SQL + """
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM pf
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pf
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       CAST(sum(support) AS BIGINT) FROM pf
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT) FROM pf""")
def j8(spark, sf):
    return J.classification_report(_rule_pred(spark, sf), _LABEL)


@register("j9_accuracy", _PRED_SQL + """SELECT round(avg(CAST(ESTATUS_VICTIMA = predicted AS DOUBLE)), 6) AS accuracy
FROM pred""")
def j9(spark, sf):
    return J.accuracy(_rule_pred(spark, sf), _LABEL)


@register("j10_feature_importance")
def j10(spark, sf):
    feats = [c for c in _FEATS if c != S.MUNI]
    model, _, _ = forest(spark, sf, feats)
    return J.feature_importance(model, feats)


@register("j10_importance_features", _codes_sql([c for c in _FEATS if c != S.MUNI]))
def j10c(spark, sf):
    feats = [c for c in _FEATS if c != S.MUNI]
    encoded = encoded_split(spark, sf, feats)
    model, _, _ = forest(spark, sf, feats, encoded)
    return _checked_importance(J.feature_importance(model, feats), encoded[1])


@register("j11_compare_models")
def j11(spark, sf):
    reps, split = {}, split_table(spark, sf)
    for name, feats in [("model1", _FEATS), ("model2", [c for c in _FEATS if c != S.MUNI])]:
        model, test, _ = forest(spark, sf, feats, encoded_split(spark, sf, feats, split))
        reps[name] = J.classification_report(J.predict(model, test, _LABEL), _LABEL)
    reps["group_majority"] = J.classification_report(_rule_pred(spark, sf, split=split), _LABEL)
    return J.compare_models(reps, "NO LOCALIZADA")


def _compared_sql(by):
    """One row of ``compare_models`` for the majority class of the row's group."""
    return f"""SELECT '{by}' AS model, * FROM (
{_PRED_SQL.replace("MUNICIPIO", by)}
SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(avg(f1), 6) AS macro_f1,
  max(CASE WHEN class = 'NO LOCALIZADA' THEN round(precision, 6) END) AS minority_precision,
  max(CASE WHEN class = 'NO LOCALIZADA' THEN round(recall, 6) END) AS minority_recall,
  max(CASE WHEN class = 'NO LOCALIZADA' THEN round(f1, 6) END) AS minority_f1 FROM pf)"""


@register("j11_compare_rules", " UNION ALL ".join(_compared_sql(c) for c in (S.SEX, S.STATE)))
def j11r(spark, sf):
    """The comparison of predictions that SQL can repeat."""
    return J.compare_models({c: J.classification_report(_rule_pred(spark, sf, c), _LABEL)
                             for c in (S.SEX, S.STATE)}, "NO LOCALIZADA")


@register("j12_confusion_matrix", _PRED_SQL + "SELECT actual, predicted, count FROM cm")
def j12(spark, sf):
    return J.confusion_matrix(_rule_pred(spark, sf), _LABEL)


@register("j13_majority_baseline", P_MIN + """SELECT round(max(c) / sum(c), 6) AS baseline_accuracy FROM
  (SELECT count(*) AS c FROM mining GROUP BY ESTATUS_VICTIMA)""")
def j13(spark, sf):
    return J.majority_baseline(model_table(spark, sf), _LABEL)


# ---- flagship: state profile (withheld share, age and delay by state) -------------

@register("q0_state_profile", P_CLEAN + f"""
SELECT ENTIDAD, CAST(sum({_WH}) AS BIGINT) AS withheld, count(*) AS n,
  round(round(sum({_WH}) * 100.0 / count(*), 1), 6) AS withheld_pct,
  round(avg(EDAD), 6) AS mean_age, round(median(EDAD), 6) AS median_age,
  round(avg(DIAS_REGISTRO), 6) AS mean_delay, round(median(DIAS_REGISTRO), 6) AS median_delay
FROM (SELECT *,
  CASE WHEN year(FECHA_DESAPARICION_DT) - year(FECHA_NACIMIENTO_DT) BETWEEN 0 AND 110
       THEN year(FECHA_DESAPARICION_DT) - year(FECHA_NACIMIENTO_DT) END AS EDAD,
  CASE WHEN floor((epoch(FECHA_REGISTRO_DT) - epoch(FECHA_DESAPARICION_DT)) / 86400) >= 0
       THEN floor((epoch(FECHA_REGISTRO_DT) - epoch(FECHA_DESAPARICION_DT)) / 86400) END AS DIAS_REGISTRO
  FROM general) GROUP BY ENTIDAD""")
def q0(spark, sf):
    """Registry -> clean (D3, D5, E1-E4) -> F1/F2 -> one grouped aggregate by
    state: withheld share (G20 without the cut) and mean/median age and delay
    (G2).  Withheld rows have no parsed dates, so their ages and delays are
    null and the temporal statistics equal those of the temporal product."""
    g = FE.delay_days(FE.age_years_diff(B2.withheld_total(general(spark, sf))))
    return g.groupBy(S.STATE).agg(
        F.sum("confidencial_total").cast("long").alias("withheld"), F.count(F.lit(1)).alias("n"),
        r6(F.round(F.sum("confidencial_total") * 100.0 / F.count(F.lit(1)), 1)).alias("withheld_pct"),
        r6(F.avg("EDAD")).alias("mean_age"), r6(F.median("EDAD")).alias("median_age"),
        r6(F.avg("DIAS_REGISTRO")).alias("mean_delay"), r6(F.median("DIAS_REGISTRO")).alias("median_delay"))


_M3_CATS = [S.SOURCE, S.SEX, S.STATE]


def forest_model3(spark, sf):
    """J6 model 3: the registry as read, no row removed and no category
    normalised (withheld rows kept, so the target has three classes and the
    withheld sentinel leaks through SEXO), one-hot institution / sex / state
    plus imputed age and delay, 70/30 random split."""
    g = FE.delay_imputed(FE.age_floor_imputed(E.parse_dates(raw(spark, sf))))
    g = g.select(S.ID, _LABEL, *_M3_CATS, "EDAD", "RETRASO_REGISTRO")
    sp = I._checkpoint(J.random_split(g, 0.3, 42, S.ID))
    train = J.balanced_weights(sp.where(F.col(J.SPLIT) == "train"), _LABEL)
    model, names = J.train_forest_onehot(train, _M3_CATS, ["EDAD", "RETRASO_REGISTRO"], _LABEL)
    return model, sp.where(F.col(J.SPLIT) == "test"), names


_M3_SQL = O.with_ctes(O.REGISTRY, """
placed AS (SELECT *, row_number() OVER (ORDER BY md5(ID_VICTIMA || '#42'), ID_VICTIMA)
                       <= ceil(0.3 * CAST(count(*) OVER () AS DOUBLE)) AS tested FROM registry)""")


@register("j6_forest_model3_importance")
def j6m3(spark, sf):
    model, _, names = forest_model3(spark, sf)
    return J.feature_importance(model, names, 10)


@register("j6_forest_model3_names", _M3_SQL + " UNION ALL ".join(
    f"SELECT DISTINCT '{c}_' || {c} AS feature, TRUE AS in_range, CAST(1 AS DOUBLE) AS total FROM placed "
    f"WHERE NOT tested AND {c} IS NOT NULL" for c in _M3_CATS)
    + " UNION ALL SELECT unnest(['EDAD', 'RETRASO_REGISTRO']), TRUE, CAST(1 AS DOUBLE)")
def j6m3n(spark, sf):
    """One dummy for every value that training met, none for null."""
    model, _, names = forest_model3(spark, sf)
    imp = J.feature_importance(model, names)
    total = scalars(imp.agg(F.sum("importance").alias("t")))["t"]
    return imp.select("feature", F.col("importance").between(0, 1).alias("in_range"), r6(total).alias("total"))


@register("j8_forest_model3_report")
def j8m3(spark, sf):
    model, test, _ = forest_model3(spark, sf)
    from pyspark.ml.feature import IndexToString
    pred = IndexToString(inputCol="prediction", outputCol="predicted",
                         labels=model.stages[0].labels).transform(model.transform(test))
    return J.classification_report(pred, _LABEL)


@register("j8_forest_model3_supports", _M3_SQL + ", picked AS (SELECT * FROM placed WHERE tested)\n"
          + _support_sql("picked"))
def j8m3s(spark, sf):
    return _checked_report(j8m3(spark, sf))


# ---- earlier item set (status and years): same algorithms, own checks ----------

@register("i7_apriori_years", P_ITEMS_YEARS + "SELECT k, itemset, freq, round(freq / (SELECT n FROM thr), 6) AS support "
          "FROM itemsets")
def i7y(spark, sf):
    return _itemset_out(mined(spark, sf, years=True).itemsets)


@register("i13_generate_rules_years", P_ITEMS_YEARS + f"SELECT {_RULE_COLS} FROM rules")
def i13y(spark, sf):
    return R.rule_text(rules(spark, sf, years=True))


@register("i15_consequent_on_status", P_ITEMS_YEARS + f"""SELECT {_RULE_COLS} FROM rules
WHERE nc = 1 AND consequents LIKE 'ESTATUS_VICTIMA%'""")
def i15s(spark, sf):
    return R.rule_text(R.consequent_on(R.single_consequent(rules(spark, sf, years=True)), "ESTATUS_VICTIMA"))


@register("i15_consequent_on_state_years", P_ITEMS_YEARS + f"""SELECT {_RULE_COLS} FROM rules
WHERE nc = 1 AND consequents LIKE 'ENTIDAD%'""")
def i15e(spark, sf):
    return R.rule_text(R.consequent_on(R.single_consequent(rules(spark, sf, years=True)), "ENTIDAD"))


@register("i18_interpret_lift_years", P_ITEMS_YEARS + f"""SELECT {_RULE_COLS}, CASE WHEN lift > 1 THEN 'Asociación positiva'
  WHEN lift = 1 THEN 'Independencia' ELSE 'Asociación negativa' END AS interpretacion_lift FROM rules WHERE nc = 1""")
def i18y(spark, sf):
    r = R.interpret_lift(R.single_consequent(rules(spark, sf, years=True)))
    return R.rule_text(r, extra=["interpretacion_lift"])
