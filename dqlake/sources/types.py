"""Column types that follow the deliveries: seen, merged and widened, never narrowed.

For each delivery and column the values that do not fit a type are counted, for all types in one
aggregate. Counts add up, so the type of a column over any set of deliveries is the narrowest that no
value of them contradicts, whatever the order in which they came.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from dqlake.functions import n_if

# Types from narrow to wide with the text they take; a value must also be within the
# type's range. What fits a type fits the wider ones of its kind: int, bigint, double and date, timestamp.
PATTERNS = {
    "boolean": r"^(?i:true|false)$",
    "int": r"^[+-]?[0-9]+$",
    "bigint": r"^[+-]?[0-9]+$",
    "double": r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?)?$",
}
NARROW_FIRST = (*PATTERNS, "string")


def fits(value: Column, kind: str) -> Column:
    """Whether a text value can be kept as ``kind``."""
    if kind == "string":
        return F.lit(True)
    return value.rlike(PATTERNS[kind]) & value.try_cast(kind).isNotNull()


def observe_types(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """(by, column_name, value_count, no_boolean, … no_timestamp): values of each text column and delivery
    and, for each type, those that do not fit it. One pass; NULL values contradict nothing."""
    aggs = []
    for i, c in enumerate(columns):
        aggs.append(F.count(c).alias(f"n_{i}"))
        aggs += [n_if(F.col(c).isNotNull() & ~fits(F.col(c), kind)).alias(f"{kind}_{i}") for kind in PATTERNS]
    row = df.groupBy(by).agg(*aggs)
    items = [F.struct(F.lit(c).alias("column_name"), F.col(f"n_{i}").alias("value_count"),
                      *[F.col(f"{kind}_{i}").alias(f"no_{kind}") for kind in PATTERNS]) for i, c in enumerate(columns)]
    return row.select(by, F.explode(F.array(*items)).alias("p")).select(by, "p.*")


def narrowest(count: Column, misfits: Mapping[str, Column]) -> Column:
    """The first type without misfits; ``void`` where no value was seen."""
    out = F.when(F.coalesce(count, F.lit(0)) == 0, "void")
    for kind, bad in misfits.items():
        out = out.when(bad == 0, kind)
    return out.otherwise("string")


def merged_types(observed: DataFrame) -> DataFrame:
    """(column_name, value_count, type) over all deliveries observed."""
    total = observed.groupBy("column_name").agg(F.sum("value_count").alias("value_count"),
                                                *[F.sum(f"no_{k}").alias(f"no_{k}") for k in PATTERNS])
    kind = narrowest(F.col("value_count"), {k: F.col(f"no_{k}") for k in PATTERNS})
    return total.select("column_name", "value_count", kind.alias("type"))


def type_drift(observed: DataFrame, by: str) -> DataFrame:
    """How each delivery, in the order of ``by``, moved the type of a column.

    ``delivery_type`` is what the delivery alone would give, ``known_type`` what those before it gave,
    ``merged_type`` what both give together, ``contradictions`` the values of the delivery that the
    known type could not hold. A column's group is as long as the number of deliveries.
    """
    past = Window.partitionBy("column_name").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("column_name").orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def over(w) -> Column:
        return narrowest(F.sum("value_count").over(w), {k: F.sum(f"no_{k}").over(w) for k in PATTERNS})

    own = narrowest(F.col("value_count"), {k: F.col(f"no_{k}") for k in PATTERNS})
    out = observed.withColumns({"delivery_type": own, "known_type": over(past), "merged_type": over(upto)})
    lost = F.lit(0).cast("long")
    for k in PATTERNS:
        lost = F.when(F.col("known_type") == k, F.col(f"no_{k}")).otherwise(lost)
    return out.select(by, "column_name", "value_count", "delivery_type", "known_type", "merged_type", lost.alias("contradictions"))
