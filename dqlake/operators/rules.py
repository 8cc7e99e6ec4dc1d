"""Named data-quality rules: validate, warn, route."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

FAILURES = "_dq_failures"
VALID = "_is_valid"


class Rule(NamedTuple):
    """``fails`` is TRUE for a broken row; NULL counts as not broken."""

    name: str
    fails: Column


# Rule templates. Comparisons of two columns fire only when both are known.

def missing(name: str, c: str) -> Rule:
    return Rule(name, F.col(c).isNull())


def unknown(name: str, c: str, matched: str) -> Rule:
    """The value is there but the reference column it should have met is not."""
    return Rule(name, F.col(c).isNotNull() & F.col(matched).isNull())


def mismatch(name: str, c: str, related: str) -> Rule:
    """The row and its matched parent disagree."""
    return Rule(name, F.col(c) != F.col(related))


def not_in(name: str, c: str, values: Sequence[str], null_fails: bool = True) -> Rule:
    bad = ~F.col(c).isin(*values)
    return Rule(name, F.col(c).isNull() | bad if null_fails else bad)


def between(name: str, c: str, low, high, null_fails: bool = True) -> Rule:
    bad = ~F.col(c).between(low, high)
    return Rule(name, F.col(c).isNull() | bad if null_fails else bad)


def before(name: str, earlier: str, later: str) -> Rule:
    """``earlier`` must not precede ``later``: fails when it does."""
    return Rule(name, F.col(earlier) < F.col(later))


def required_when(name: str, cond: Column, c: str) -> Rule:
    return Rule(name, cond & F.col(c).isNull())


def unparseable(name: str, raw: str, parsed: str) -> Rule:
    return Rule(name, F.col(raw).isNotNull() & F.col(parsed).isNull())


def bad_range(name: str, present: str, low: str, high: str) -> Rule:
    """A matched range (``present`` known) with a missing or crossed bound."""
    lo_, hi_ = F.col(low), F.col(high)
    return Rule(name, F.col(present).isNotNull() & (lo_.isNull() | hi_.isNull() | (lo_ > hi_)))


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add every failed rule name in rule order, and whether the row is valid.

    The conditions of all rules compile into one test; the names are collected
    only for rows that fail it. ``array_compact`` also keeps this projection
    out of the fused stage of the lookups before it: together they would pass
    the size (8000 bytes of code) above which the JVM no longer compiles a
    method, and run several times slower.
    """
    broken = reduce(or_, [F.coalesce(r.fails, F.lit(False)) for r in rules])
    names = F.array_compact(F.array(*[F.when(r.fails, F.lit(r.name)) for r in rules]))
    none = F.array().cast("array<string>")
    return df.withColumns({FAILURES: F.when(broken, names).otherwise(none), VALID: ~broken})


def warn(df: DataFrame, warnings: Mapping[str, Column]) -> DataFrame:
    """Non-blocking flags; three-valued, so an unknown input gives NULL."""
    return df.withColumns(dict(warnings))


def valid_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(VALID)).drop(FAILURES, VALID)


def quarantine(df: DataFrame, as_of: Column) -> DataFrame:
    """Rejected rows with all reasons, as an array and as ``;`` text."""
    return (
        df.where(~F.col(VALID))
        .withColumn("dq_failure_reasons", F.array_join(FAILURES, ";"))
        .withColumn("quarantined_at", as_of.cast("timestamp"))
        .drop(VALID)
    )


class Routed(NamedTuple):
    valid: DataFrame
    quarantine: DataFrame


def route(df: DataFrame, as_of: Column) -> Routed:
    """Both sides of a validated frame; every row is on exactly one side."""
    return Routed(valid_rows(df), quarantine(df, as_of))


def failures(df: DataFrame, name: str = "dq_rule") -> DataFrame:
    """One row per failed rule of each row."""
    return df.withColumn(name, F.explode(FAILURES))


def requarantine(rejected: DataFrame, revalidate, as_of: Column) -> Routed:
    """Test rejected rows again, e.g. after a late parent became trusted.

    ``revalidate`` is the function that validated them first; it receives the
    rows without the routing columns.
    """
    rows = rejected.drop(FAILURES, "dq_failure_reasons", "quarantined_at")
    return route(revalidate(rows), as_of)

