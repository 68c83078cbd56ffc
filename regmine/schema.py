"""Column names, sentinels and fixed values of the registry data model.

The registry is one flat table of text columns with three distinct kinds of
absence that are never merged: null (never captured), the withheld sentinel
(deliberately hidden) and the unknown sentinels / codes.
"""

ID = "ID_VICTIMA"
SOURCE = "ORIGEN_REPORTE"
BIRTH = "FECHA_NACIMIENTO"
SEX = "SEXO"
DISAPPEARED = "FECHA_DESAPARICION"
REGISTERED = "FECHA_REGISTRO"
STATUS = "ESTATUS_VICTIMA"
STATE_CODE = "CVE_ENT"
STATE = "ENTIDAD"
MUNI_CODE = "CVE_MUN"
MUNI = "MUNICIPIO"

RAW_COLUMNS = [ID, SOURCE, BIRTH, SEX, DISAPPEARED, REGISTERED, STATUS,
               STATE_CODE, STATE, MUNI_CODE, MUNI]
DATE_COLUMNS = [BIRTH, DISAPPEARED, REGISTERED]
CATEGORY_COLUMNS = [SOURCE, SEX, STATUS, STATE, MUNI]
TEXT_COLUMNS = [ID, SOURCE, BIRTH, SEX, DISAPPEARED, REGISTERED, STATUS, STATE, MUNI]
CODE_COLUMNS = [STATE_CODE, MUNI_CODE]
# Columns that carry the withheld block (the six sensitive variables).
SENSITIVE_COLUMNS = [BIRTH, SEX, DISAPPEARED, REGISTERED, STATUS, MUNI]

# ---- fixed values (must equal the source project's for equal results) ----
WITHHELD = "CONFIDENCIAL"
UNKNOWN = "SE DESCONOCE"
UNKNOWN_STATE_CODE = 99
UNKNOWN_MUNI_CODE = 999
MISSING_LABEL = "DESCONOCIDO"

DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd H:mm:ss"       # H accepts 4:40:00 and 04:40:00
TIMESTAMP_OUT_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Range of representable nanosecond timestamps in the source tooling; values
# outside it were treated as unparseable there.
MIN_TS = "1677-09-21 00:12:43.145225"
MAX_TS = "2262-04-11 23:47:16.854775"

# Six-year federal government terms, left-closed [start, end).
TERM_EDGES = [1994, 2000, 2006, 2012, 2018, 2024, 2030]
TERM_LABELS = [
    "Zedillo (1994-2000)",
    "Fox (2000-2006)",
    "Calderón (2006-2012)",
    "Peña Nieto (2012-2018)",
    "AMLO (2018-2024)",
    "Sheinbaum (2024-2030)",
]
# Age bands, right-closed upper edges (-inf, 11], (11, 17], ... (59, inf).
AGE_EDGES = [11, 17, 29, 44, 59]
AGE_LABELS = ["0-11", "12-17", "18-29", "30-44", "45-59", "60+"]

# Institution classes by name pattern (independent tests).
SOURCE_CLASS_RULES = [
    ("COMISION", "COMISION", None),
    ("FISCALIA", "FISCALIA GENERAL DE", None),
    ("PROCURADURIA", "PROCURADURIA", "SUBPROCURADURIA"),
    ("SUBPROCURADURIA", "SUBPROCURADURIA", None),
]

# Item columns for association mining: current and earlier variants.
ITEM_COLUMNS = ["SEXO", "ENTIDAD", "MUNICIPIO", "SEXENIO_DESAPARICION",
                "SEXENIO_REGISTRO", "MES_DESAPARICION", "GRUPO_EDAD"]
ITEM_COLUMNS_YEARS = ["SEXO", "ESTATUS_VICTIMA", "ENTIDAD", "MUNICIPIO",
                      "ANIO_DESAPARICION", "MES_DESAPARICION", "ANIO_REGISTRO",
                      "GRUPO_EDAD"]
