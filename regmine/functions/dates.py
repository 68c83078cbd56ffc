"""Date parsing and arithmetic that never raise and never count midnights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regmine import schema as S


def bounded(ts: Column, min_ts: str | None = S.MIN_TS, max_ts: str | None = S.MAX_TS) -> Column:
    """Null out timestamps outside [min_ts, max_ts] (None disables a bound).

    Written so that ``ts`` is referenced once: predicates on derived columns
    are pushed below projections with their definitions substituted, so every
    extra reference would re-run the parse underneath."""
    from regmine.functions.numeric import clamp_null
    lo = F.lit(min_ts).cast("timestamp") - F.expr("INTERVAL 1 MICROSECOND") if min_ts else None
    hi = F.lit(max_ts).cast("timestamp") + F.expr("INTERVAL 1 MICROSECOND") if max_ts else None
    return clamp_null(ts, lo, hi)


def safe_timestamp(c: Column, fmt: str, min_ts: str | None = S.MIN_TS,
                   max_ts: str | None = S.MAX_TS) -> Column:
    """Parse with one fixed pattern; sentinel text, bad dates -> null."""
    return bounded(F.try_to_timestamp(c, F.lit(fmt)), min_ts, max_ts)


def safe_timestamp_any(c: Column, formats: list[str], min_ts: str | None = S.MIN_TS,
                       max_ts: str | None = S.MAX_TS) -> Column:
    """First pattern that parses wins (explicit list instead of guessing)."""
    return bounded(F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats]),
                   min_ts, max_ts)


def floor_days_between(start: Column, end: Column) -> Column:  # noqa: D401
    """Whole days from start to end, floored toward minus infinity
    (-1 hour -> -1, 23 hours across midnight -> 0)."""
    secs = F.unix_timestamp(end) - F.unix_timestamp(start)
    return F.floor(secs / F.lit(86400)).cast("long")
