"""Standardising measured values and judging them against a range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .normalize import as_col


def standard_unit(unit_ref_unit: Column | str, test_default_unit: Column | str) -> Column:
    """Unit from the (test, raw unit) mapping, else the default unit of the test."""
    return F.coalesce(as_col(unit_ref_unit), as_col(test_default_unit))


def standard_value(value: Column | str, factor: Column | str) -> Column:
    """Value in the standard unit; NULL when the value or the factor is unknown."""
    return as_col(value) * as_col(factor)


def range_flag(value: Column | str, low: Column | str, high: Column | str) -> Column:
    """``Y`` outside the range, ``N`` inside, NULL when any part is unknown."""
    inside = as_col(value).between(as_col(low), as_col(high))
    known = as_col(value).isNotNull() & as_col(low).isNotNull() & as_col(high).isNotNull()
    return F.when(known, F.when(inside, "N").otherwise("Y"))


def range_direction(value: Column | str, low: Column | str, high: Column | str) -> Column:
    """``LOW`` / ``NORMAL`` / ``HIGH``, NULL when any part is unknown.

    A value below the low bound is LOW even if the bounds are crossed.
    """
    value, low, high = as_col(value), as_col(low), as_col(high)
    known = value.isNotNull() & low.isNotNull() & high.isNotNull()
    return F.when(known, F.when(value < low, "LOW").when(value > high, "HIGH").otherwise("NORMAL"))


def flag_discrepancy(source: Column | str, derived: Column | str) -> Column:
    """TRUE when a Y/N source flag disagrees with the derived one, NULL if either is unknown."""
    source, derived = as_col(source), as_col(derived)
    return F.when(source.isin("Y", "N"), source != derived)


def standardise(
    df: DataFrame,
    value: str,
    factor: str,
    unit_ref_unit: str,
    test_unit: str,
    low: str,
    high: str,
    source_flag: str,
) -> DataFrame:
    """Add the standard unit, value, range flag, direction and flag discrepancy.

    The arguments name columns already looked up from the references.
    """
    return (
        df.withColumns(
            {
                "standard_unit": standard_unit(unit_ref_unit, test_unit),
                "conversion_factor": as_col(factor),
                "standardized_result_value": standard_value(value, factor),
                "standard_reference_low": as_col(low),
                "standard_reference_high": as_col(high),
            }
        )
        .withColumns(
            {
                "derived_abnormal_flag": range_flag(
                    "standardized_result_value", "standard_reference_low", "standard_reference_high"
                ),
                "derived_direction": range_direction(
                    "standardized_result_value", "standard_reference_low", "standard_reference_high"
                ),
            }
        )
        .withColumn(
            "abnormal_flag_discrepancy", flag_discrepancy(source_flag, "derived_abnormal_flag")
        )
    )
