"""Discretisation expressions (age bands, government terms, month/year items)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regmine import schema as S


def age_band_expr(age: Column, edges=None, labels=None,
                  missing: str = S.MISSING_LABEL) -> Column:
    """Right-closed bands on a fractional age: (-inf, e0], (e0, e1], ..."""
    edges = edges or S.AGE_EDGES
    labels = labels or S.AGE_LABELS
    expr = F.when(age.isNull() | F.isnan(age), F.lit(missing))
    for edge, label in zip(edges, labels):
        expr = expr.when(age <= edge, F.lit(label))
    return expr.otherwise(F.lit(labels[len(edges)]))


def term_band_expr(ts: Column, edges=None, labels=None,
                   missing: str = S.MISSING_LABEL) -> Column:
    """Left-closed [edge_i, edge_i+1) on the calendar year; outside -> missing."""
    edges = edges or S.TERM_EDGES
    labels = labels or S.TERM_LABELS
    # year -> label map over the covered years; the year is referenced once.
    pairs = []
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        for y in range(lo, hi):
            pairs += [F.lit(y), F.lit(label)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.year(ts)), F.lit(missing))


def month_item_expr(ts: Column, missing: str = S.MISSING_LABEL) -> Column:
    return F.coalesce(F.lpad(F.month(ts).cast("string"), 2, "0"), F.lit(missing))


def year_item_expr(ts: Column, missing: str = S.MISSING_LABEL) -> Column:
    return F.coalesce(F.year(ts).cast("string"), F.lit(missing))
