"""Column expressions that normalise and type raw text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Trimmed text that means "no value".
PLACEHOLDERS = ("", "-")

# Spellings of a yes/no flag.
YES_WORDS = ("Y", "YES", "1", "TRUE")
NO_WORDS = ("N", "NO", "0", "FALSE")


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Trimmed text; NULL, blank and ``-`` become NULL."""
    text = F.trim(as_col(c))
    return F.when(~text.isin(*PLACEHOLDERS), text)


def normalize_key(c: Column | str) -> Column:
    """Canonical form of a business key: trimmed, upper case, placeholders NULL."""
    return F.upper(blank_to_null(c))


def normalize_category(c: Column | str) -> Column:
    """Canonical form of a categorical value; same contract as a key."""
    return normalize_key(c)


def normalize_unit(c: Column | str, strip_ws: bool = False) -> Column:
    """Unit lookup form; ``strip_ws`` also drops inner blanks (profiling only)."""
    unit = normalize_key(c)
    return F.regexp_replace(unit, r"\s+", "") if strip_ws else unit


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Replace text columns by safe casts; text that does not fit becomes NULL."""
    return df.withColumns({name: F.col(name).try_cast(t) for name, t in types.items()})


def parse_date(c: Column | str, fmt: str | None = None) -> Column:
    """DATE from text, NULL if it does not parse; ``fmt`` None means ISO."""
    text = blank_to_null(c)
    return text.try_cast("date") if fmt is None else F.try_to_date(text, fmt)


def delivery_date(file_name: Column | str, prefix: str, anchored: bool = True) -> Column:
    """Logical delivery date carried by a file name ``<prefix>_YYYYMMDD.csv``."""
    pattern = rf"{prefix}_(\d{{8}})\.csv"
    if anchored:
        pattern = f"^{pattern}$"
    return F.try_to_date(F.regexp_extract(as_col(file_name), pattern, 1), "yyyyMMdd")


def map_values(
    c: Column | str,
    mapping: Mapping[str, Sequence[str]],
    null_as: str | None = None,
    default: str | None = "keep",
) -> Column:
    """Map listed spellings to standard values.

    ``mapping`` is ``{standard: [spellings]}``. ``null_as`` is the value for
    missing text. ``default="keep"`` passes other values through, None drops
    them to NULL, any other text replaces them.
    """
    value = normalize_category(c)
    out = F.when(value.isNull(), F.lit(null_as).cast("string"))
    for standard, spellings in mapping.items():
        out = out.when(value.isin(*spellings), F.lit(standard))
    return out.otherwise(value if default == "keep" else F.lit(default).cast("string"))


def map_flag(c: Column | str) -> Column:
    """YES / NO from the usual spellings, NULL otherwise."""
    return map_values(c, {"YES": YES_WORDS, "NO": NO_WORDS}, default=None)


def band(c: Column | str, cuts: Sequence[int], unknown: str = "UNKNOWN") -> Column:
    """Label a number by cut points: ``<a``, ``a-b`` ..., ``>=z``; NULL is ``unknown``."""
    value = as_col(c)
    out = F.when(value.isNull(), F.lit(unknown)).when(value < cuts[0], F.lit(f"<{cuts[0]}"))
    for low, high in zip(cuts, cuts[1:]):
        out = out.when(value < high, F.lit(f"{low}-{high}"))
    return out.otherwise(F.lit(f">={cuts[-1]}"))


def elapsed_days(start: Column | str, end: Column | str | None, as_of: Column) -> Column:
    """Days from ``start`` to ``end``, or to ``as_of`` while ``end`` is open."""
    stop = as_of if end is None else F.coalesce(as_col(end), as_of)
    return F.datediff(stop, as_col(start))


def stamp(df: DataFrame, name: str, as_of: Column) -> DataFrame:
    """Audit timestamp column; the caller fixes ``as_of`` so reruns repeat."""
    return df.withColumn(name, as_of.cast("timestamp"))


def is_missing(c: Column | str) -> Column:
    """TRUE for NULL, blank or placeholder text; never NULL."""
    return blank_to_null(as_col(c).cast("string")).isNull()
