"""Text column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# (?U) makes \s Unicode-aware, so no-break and other wide spaces count.
_EDGE_WS = r"(?U)^\s+|\s+$"
_INNER_WS = r"(?U)\s+"


def normalize_text(c: Column) -> Column:
    """Strip all whitespace at both ends, collapse inner runs to one space,
    upper-case.  Null stays null."""
    return F.upper(F.regexp_replace(F.regexp_replace(c, _EDGE_WS, ""), _INNER_WS, " "))


def strip_text(c: Column) -> Column:
    """Strip leading/trailing whitespace only (case and inner spaces kept)."""
    return F.regexp_replace(c, _EDGE_WS, "")


def is_value(c: Column, value: str) -> Column:
    """Null-safe equality: null never matches, result never null."""
    return c.eqNullSafe(F.lit(value))


def not_equal_null_safe(c: Column, value: str) -> Column:
    """``c != value`` where a null ``c`` counts as different (kept)."""
    return ~c.eqNullSafe(F.lit(value))
