"""Aggregate expressions that the metric tables are made of."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .normalize import as_col


def n() -> Column:
    return F.count(F.lit(1))


def n_if(cond: Column) -> Column:
    return F.count_if(cond)


def total(c: Column | str) -> Column:
    return F.sum(as_col(c))


def lo(c: Column | str) -> Column:
    return F.min(as_col(c))


def hi(c: Column | str) -> Column:
    return F.max(as_col(c))


def n_distinct(*cols: Column | str, approx: bool = False) -> Column:
    """Distinct values; several columns count as one struct, NULL fields included."""
    value = as_col(cols[0]) if len(cols) == 1 else F.struct(*[as_col(c) for c in cols])
    return F.approx_count_distinct(value) if approx else F.count_distinct(value)


def n_distinct_if(cond: Column, c: Column | str, approx: bool = False) -> Column:
    return n_distinct(F.when(cond, as_col(c)), approx=approx)


def ever(cond: Column) -> Column:
    """1 if any row of the group meets the condition, else 0."""
    return F.max(F.when(cond, 1).otherwise(0))


def median(c: Column | str) -> Column:
    """Median as an existing value; a mergeable sketch, so it combines map-side."""
    return F.percentile_approx(as_col(c), 0.5)


def variants(c: Column | str) -> Column:
    """Sorted distinct values. Only for columns whose domain is bounded
    (categories, file names): the result is one array per group."""
    return F.array_sort(F.collect_set(as_col(c)))


def rate(num: Column | str, den: Column | str) -> Column:
    """``num / den``; NULL when the denominator is zero or unknown."""
    num, den = as_col(num), as_col(den)
    return F.when(den > 0, num / den)
