"""Independent SQL (DuckDB dialect) for every registered query.

The registry view and the cleaning chain are written here a second time, as
CTEs over the same parquet tables, so that the Spark plans can be checked
against an engine that shares no code with them.
"""

from __future__ import annotations

REGISTRY = r"""
registry_base AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS cust, o.o_orderstatus AS st,
         o.o_orderdate AS d0, n.n_nationkey AS nk, n.n_name AS nm, s.ship
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS ship FROM lineitem GROUP BY l_orderkey) s
         ON o.o_orderkey = s.l_orderkey
),
registry AS (
  SELECT
    CAST(k AS VARCHAR) AS ID_VICTIMA,
    CASE WHEN k % 13 = 0 THEN 'SE DESCONOCE'
         WHEN cust % 5 = 0 THEN 'COMISION LOCAL DE ' || nm
         WHEN cust % 5 = 1 THEN 'FISCALIA GENERAL DE ' || nm
         WHEN cust % 5 = 2 THEN 'PROCURADURIA DE ' || nm
         WHEN cust % 5 = 3 THEN 'SUBPROCURADURIA DE ' || nm
         ELSE 'PORTAL' END AS ORIGEN_REPORTE,
    CASE WHEN k % 11 = 0 THEN 'CONFIDENCIAL'
         WHEN k % 23 = 0 THEN NULL
         WHEN k % 29 = 0 THEN '31/02/1980'
         WHEN k % 31 = 0 THEN strftime(d0 + INTERVAL 400 DAY, '%Y-%m-%d')
         ELSE strftime(d0 - to_days(CAST((cust * 37 + k) % 33000 AS INTEGER)), '%Y-%m-%d') END
      AS FECHA_NACIMIENTO,
    CASE WHEN k % 11 = 0 THEN 'CONFIDENCIAL'
         WHEN k % 241 = 0 THEN 'INDETERMINADO'
         WHEN (cust + k) % 4 = 0 THEN 'MUJER'
         ELSE 'HOMBRE' END AS SEXO,
    CASE WHEN k % 11 = 0 THEN 'CONFIDENCIAL'
         WHEN k % 37 = 0 THEN NULL
         ELSE strftime(d0 + to_seconds(CAST((k * 61) % 86400 AS BIGINT)), '%Y-%m-%d %H:%M:%S') END
      AS FECHA_DESAPARICION,
    CASE WHEN k % 11 = 0 THEN 'CONFIDENCIAL'
         WHEN k % 41 = 0 OR ship IS NULL THEN NULL
         WHEN k % 5 = 0 THEN strftime(ship + to_seconds(CAST((k * 47) % 86400 AS BIGINT)),
                                      '%Y-%m-%d %H:%M:%S')
         ELSE strftime(d0 + to_days(CAST(k % 9 AS INTEGER))
                          + to_seconds(CAST((k * 47) % 86400 AS BIGINT)), '%Y-%m-%d %H:%M:%S') END
      AS FECHA_REGISTRO,
    CASE WHEN k % 11 = 0 THEN 'CONFIDENCIAL'
         WHEN st = 'F' AND k % 3 = 0 THEN 'NO LOCALIZADA'
         ELSE 'DESAPARECIDA' END AS ESTATUS_VICTIMA,
    CAST(CASE WHEN k % 7 = 0 OR k % 997 = 1 THEN 99 ELSE nk + 1 END AS VARCHAR) AS CVE_ENT,
    CASE WHEN k % 7 = 0 THEN 'SE DESCONOCE'
         WHEN k % 101 = 0 THEN ' ' || lower(replace(nm, '_', '  ')) || ' '
         ELSE replace(nm, '_', ' ') END AS ENTIDAD,
    CAST(CASE WHEN k % 11 = 0 THEN 999 ELSE cust % 50 + 1 END AS VARCHAR) AS CVE_MUN,
    CASE WHEN k % 11 = 0 THEN 'CONFIDENCIAL'
         WHEN k % 53 = 0 THEN 'SE DESCONOCE'
         ELSE replace(nm, '_', ' ') || ' M' || CAST(cust % 50 + 1 AS VARCHAR) END AS MUNICIPIO
  FROM registry_base
)"""

# Cleaning chain: flags on raw text, minimum-information rows removed, codes
# typed, categories normalised, dates parsed, temporal product with flags.
NORM = "upper(regexp_replace(regexp_replace({c}, '^[\\s\\pZ]+|[\\s\\pZ]+$', '', 'g'), '[\\s\\pZ]+', ' ', 'g'))"
LONG = ("CASE WHEN TRY_CAST({c} AS DOUBLE) = floor(TRY_CAST({c} AS DOUBLE)) "
        "THEN CAST(TRY_CAST({c} AS DOUBLE) AS BIGINT) END")
TS_BOUND = ("CASE WHEN {e} BETWEEN TIMESTAMP '1677-09-21 00:12:43.145225' "
            "AND TIMESTAMP '2262-04-11 23:47:16.854775' THEN {e} END")


def _norm(c: str) -> str:
    return NORM.format(c=c)


def _ts(col: str, fmt: str) -> str:
    return TS_BOUND.format(e=f"try_strptime({col}, '{fmt}')")


CLEAN = rf"""
flagged AS (
  SELECT *,
    CASE WHEN FECHA_NACIMIENTO IS NOT DISTINCT FROM 'CONFIDENCIAL'
          AND ENTIDAD IS DISTINCT FROM 'SE DESCONOCE' THEN 1 ELSE 0 END AS confidencial_con_estado,
    CASE WHEN FECHA_NACIMIENTO IS NOT DISTINCT FROM 'CONFIDENCIAL'
          AND ENTIDAD IS NOT DISTINCT FROM 'SE DESCONOCE' THEN 1 ELSE 0 END AS confidencial_sin_estado
  FROM registry
),
base AS (
  SELECT * FROM flagged
  WHERE NOT (FECHA_NACIMIENTO IS NOT DISTINCT FROM 'CONFIDENCIAL'
             AND ENTIDAD IS NOT DISTINCT FROM 'SE DESCONOCE'
             AND ORIGEN_REPORTE IS NOT DISTINCT FROM 'SE DESCONOCE')
),
typed AS (
  SELECT ID_VICTIMA, {_norm('ORIGEN_REPORTE')} AS ORIGEN_REPORTE, FECHA_NACIMIENTO,
         {_norm('SEXO')} AS SEXO, FECHA_DESAPARICION, FECHA_REGISTRO,
         {_norm('ESTATUS_VICTIMA')} AS ESTATUS_VICTIMA,
         {LONG.format(c='CVE_ENT')} AS CVE_ENT, {_norm('ENTIDAD')} AS ENTIDAD,
         {LONG.format(c='CVE_MUN')} AS CVE_MUN, {_norm('MUNICIPIO')} AS MUNICIPIO,
         confidencial_con_estado, confidencial_sin_estado
  FROM base
),
general AS (
  SELECT *,
    {_ts('FECHA_NACIMIENTO', '%Y-%m-%d')} AS FECHA_NACIMIENTO_DT,
    {_ts('FECHA_DESAPARICION', '%Y-%m-%d %H:%M:%S')} AS FECHA_DESAPARICION_DT,
    {_ts('FECHA_REGISTRO', '%Y-%m-%d %H:%M:%S')} AS FECHA_REGISTRO_DT
  FROM typed
),
temporal AS (
  SELECT *,
    CAST(FECHA_NACIMIENTO IS NULL AS INTEGER) AS nulo_fecha_nacimiento,
    CAST(FECHA_DESAPARICION IS NULL AS INTEGER) AS nulo_fecha_desaparicion,
    CAST(FECHA_REGISTRO IS NULL AS INTEGER) AS nulo_fecha_registro,
    CAST(FECHA_NACIMIENTO IS NOT NULL AND FECHA_NACIMIENTO_DT IS NULL AS INTEGER) AS flag_nacimiento_invalido,
    CAST(FECHA_DESAPARICION IS NOT NULL AND FECHA_DESAPARICION_DT IS NULL AS INTEGER) AS flag_desaparicion_invalido,
    CAST(FECHA_REGISTRO IS NOT NULL AND FECHA_REGISTRO_DT IS NULL AS INTEGER) AS flag_registro_invalido,
    CAST(coalesce(FECHA_NACIMIENTO_DT > FECHA_DESAPARICION_DT, false) AS INTEGER) AS flag_nacimiento_despues_desaparicion,
    CAST(coalesce(FECHA_NACIMIENTO_DT > FECHA_REGISTRO_DT, false) AS INTEGER) AS flag_nacimiento_despues_registro,
    CAST(coalesce(FECHA_REGISTRO_DT < FECHA_DESAPARICION_DT, false) AS INTEGER) AS flag_registro_antes_desaparicion
  FROM general
  WHERE FECHA_NACIMIENTO IS DISTINCT FROM 'CONFIDENCIAL'
),
measures AS (
  SELECT *,
    CASE WHEN year(FECHA_DESAPARICION_DT) - year(FECHA_NACIMIENTO_DT) BETWEEN 0 AND 110
         THEN CAST(year(FECHA_DESAPARICION_DT) - year(FECHA_NACIMIENTO_DT) AS BIGINT) END AS EDAD,
    CASE WHEN floor((epoch(FECHA_REGISTRO_DT) - epoch(FECHA_DESAPARICION_DT)) / 86400) >= 0
         THEN CAST(floor((epoch(FECHA_REGISTRO_DT) - epoch(FECHA_DESAPARICION_DT)) / 86400) AS BIGINT)
         END AS DIAS_REGISTRO
  FROM temporal
)"""

TERM = """CASE WHEN {y} IS NULL THEN 'DESCONOCIDO'
  WHEN {y} >= 1994 AND {y} < 2000 THEN 'Zedillo (1994-2000)'
  WHEN {y} >= 2000 AND {y} < 2006 THEN 'Fox (2000-2006)'
  WHEN {y} >= 2006 AND {y} < 2012 THEN 'Calderón (2006-2012)'
  WHEN {y} >= 2012 AND {y} < 2018 THEN 'Peña Nieto (2012-2018)'
  WHEN {y} >= 2018 AND {y} < 2024 THEN 'AMLO (2018-2024)'
  WHEN {y} >= 2024 AND {y} < 2030 THEN 'Sheinbaum (2024-2030)'
  ELSE 'DESCONOCIDO' END"""

AGE_BAND = """CASE WHEN {a} IS NULL THEN 'DESCONOCIDO' WHEN {a} <= 11 THEN '0-11'
  WHEN {a} <= 17 THEN '12-17' WHEN {a} <= 29 THEN '18-29' WHEN {a} <= 44 THEN '30-44'
  WHEN {a} <= 59 THEN '45-59' ELSE '60+' END"""

STRIP = "regexp_replace({c}, '^[\\s\\pZ]+|[\\s\\pZ]+$', '', 'g')"

MINING = rf"""
mining_dt AS (
  SELECT *,
    {_ts('FECHA_DESAPARICION', '%Y-%m-%d %H:%M:%S')} AS DIS_DT,
    {_ts('FECHA_REGISTRO', '%Y-%m-%d %H:%M:%S')} AS REG_DT,
    {_ts('FECHA_NACIMIENTO', '%Y-%m-%d')} AS NAC_DT
  FROM registry
  WHERE SEXO IS DISTINCT FROM 'CONFIDENCIAL' AND ESTATUS_VICTIMA IS DISTINCT FROM 'CONFIDENCIAL'
    AND MUNICIPIO IS DISTINCT FROM 'CONFIDENCIAL'
),
mining_age AS (
  SELECT *,
    CASE WHEN floor((epoch(DIS_DT) - epoch(NAC_DT)) / 86400) / 365.25 BETWEEN 0 AND 120
         THEN floor((epoch(DIS_DT) - epoch(NAC_DT)) / 86400) / 365.25 END AS EDAD_FRAC
  FROM mining_dt
),
mining AS (
  SELECT *,
    {TERM.format(y='year(DIS_DT)')} AS SEXENIO_DESAPARICION,
    {TERM.format(y='year(REG_DT)')} AS SEXENIO_REGISTRO,
    coalesce(lpad(CAST(month(DIS_DT) AS VARCHAR), 2, '0'), 'DESCONOCIDO') AS MES_DESAPARICION,
    {AGE_BAND.format(a='EDAD_FRAC')} AS GRUPO_EDAD,
    coalesce(CAST(year(DIS_DT) AS VARCHAR), 'DESCONOCIDO') AS ANIO_DESAPARICION,
    coalesce(CAST(year(REG_DT) AS VARCHAR), 'DESCONOCIDO') AS ANIO_REGISTRO
  FROM mining_age
)"""


def tx_items(cols: list[str]) -> str:
    """Long form (tx_id, item) of the mining transactions."""
    parts = []
    for c in cols:
        v = STRIP.format(c=f"CAST({c} AS VARCHAR)")
        parts.append(f"SELECT ID_VICTIMA AS tx_id, '{c}=' || {v} AS item FROM mining "
                     f"WHERE {c} IS NOT NULL AND {v} <> '' AND {v} <> 'nan'")
    return "tx_items AS (SELECT DISTINCT tx_id, item FROM (" + " UNION ALL ".join(parts) + "))"


ITEM_COLS = ["SEXO", "ENTIDAD", "MUNICIPIO", "SEXENIO_DESAPARICION", "SEXENIO_REGISTRO",
             "MES_DESAPARICION", "GRUPO_EDAD"]
ITEM_COLS_YEARS = ["SEXO", "ESTATUS_VICTIMA", "ENTIDAD", "MUNICIPIO", "ANIO_DESAPARICION",
                   "MES_DESAPARICION", "ANIO_REGISTRO", "GRUPO_EDAD"]


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


PREFIX_RAW = with_ctes(REGISTRY)
PREFIX_CLEAN = with_ctes(REGISTRY, CLEAN)
PREFIX_MINING = with_ctes(REGISTRY, MINING)
