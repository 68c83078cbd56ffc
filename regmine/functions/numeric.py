"""Numeric helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def r6(c: Column, digits: int = 6) -> Column:
    """Round a real result for stable comparison; ``+ 0.0`` folds -0.0 to 0.0
    and NaN is turned into null."""
    v = F.round(c.cast("double"), digits) + F.lit(0.0)
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def safe_long(c: Column) -> Column:
    """Text -> nullable integer; '9.0' -> 9, '9.5' / 'x' / null -> null."""
    d = c.try_cast("double")
    return F.when(d == F.floor(d), d.cast("long"))


def try_ratio(num: Column, den: Column) -> Column:
    """num / den as double, null when den is 0 or null (ANSI-safe)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def clamp_null(x: Column, below: Column | None = None, above: Column | None = None) -> Column:
    """x when below < x < above (exclusive sentinels), else null -- with x
    referenced exactly once.

    Predicates on derived columns are pushed below projections with the
    definitions substituted (and null-intolerance constraints inferred from
    every sub-expression), so each extra reference of an expensive input (a
    timestamp parse) would be evaluated again underneath.  A one-element
    array filtered by a lambda binds the input to a variable instead;
    ``when`` and ``nullif`` (rewritten as ``if(a = b, null, a)``) would both
    duplicate it."""
    def keep(t):
        cond = F.lit(True)
        if below is not None:
            cond = cond & (t > below)
        if above is not None:
            cond = cond & (t < above)
        return cond
    return F.get(F.filter(F.array(x), keep), 0)


def scalars(one_row: DataFrame) -> dict:
    """Run a one-row aggregate now and return its fields as typed literals.

    Used for the handful of summary numbers (totals, moments, fences) that a
    later row-level expression needs: one small job, a bounded result on the
    driver, and a compact plan afterwards (a scalar subquery referenced many
    times would embed the whole upstream plan at every reference)."""
    row = one_row.first()
    out = {}
    for f in one_row.schema.fields:
        v = row[f.name] if row is not None else None
        out[f.name] = F.lit(v).cast(f.dataType)
    return out


# Largest lookup table shipped to every executor, by rows and by estimated bytes.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 << 20


def _row_bytes(df: DataFrame) -> int:
    """Estimated bytes of a row (Spark's default sizes: 20 for a text)."""
    size = {"string": 40, "double": 8, "bigint": 8, "int": 4, "boolean": 1, "date": 4, "timestamp": 8}
    return 16 + sum(size.get(f.dataType.simpleString(), 64) for f in df.schema.fields)


def broadcast_checked(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast a lookup table only after counting it (bounded by design:
    distinct values, groups, classes x buckets) and estimating its bytes.
    Above the limits the plain table is returned and the join shuffles, with
    AQE splitting skewed keys.  Broadcasting also keeps a key that holds a
    large share of the big side (a hot value or group) out of a single shuffle
    partition."""
    from pyspark.sql import functions as F
    most = min(max_rows, BROADCAST_MAX_BYTES // _row_bytes(small))
    return F.broadcast(small) if small.limit(most + 1).count() <= most else small


def broadcast_bounded(small: DataFrame, rows: int, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast_checked`` for a table that is already known to have at most
    ``rows`` rows, so nothing is counted again."""
    most = min(max_rows, BROADCAST_MAX_BYTES // _row_bytes(small))
    return F.broadcast(small) if rows <= most else small
