"""Grouped metrics, running sums, dense calendars, unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def rollup(df: DataFrame, by: Sequence[str], metrics: Mapping[str, Column]) -> DataFrame:
    """Group and compute named metrics."""
    return df.groupBy(*by).agg(*[m.alias(name) for name, m in metrics.items()])


def having(df: DataFrame, cond: Column) -> DataFrame:
    return df.where(cond)


def running_sum(
    df: DataFrame, by: Sequence[str], order: str, cols: Mapping[str, str]
) -> DataFrame:
    """Cumulative sums per group; ``cols`` maps output to input column.

    Meant for rows already rolled up to one per (group, ``order``), such as a
    calendar: the group is then as long as the calendar, whatever the facts.
    """
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({out: F.sum(c).over(w) for out, c in cols.items()})


def calendar(
    df: DataFrame, start: str, end: str, name: str, step: str = "INTERVAL 1 MONTH"
) -> DataFrame:
    """One row per step from ``start`` to ``end`` inclusive, other columns kept."""
    steps = F.explode(F.sequence(F.col(start), F.col(end), F.expr(step)))
    return df.withColumn(name, steps).drop(start, end)


def zero_fill(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(cols))


def stack(*frames: DataFrame) -> DataFrame:
    """Union by column name."""
    return reduce(DataFrame.unionByName, frames)


def top(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows: a per-partition heap and one merge, no full sort."""
    return df.orderBy(*order).limit(n)
