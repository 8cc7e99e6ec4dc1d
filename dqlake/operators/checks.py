"""Profiling and validation checks. Each returns a small DataFrame of findings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from dqlake.functions import is_missing, n, n_distinct, n_if, parse_date, rate, variants

from .resolve import dedupe_latest, lookup, orphans
from .rollup import stack
from .rules import FAILURES, Rule
from .scd import END, HOT_ROWS, START, scd2

LINEAGE = (
    "_source_file", "_source_file_name", "_source_file_modification_ts", "_ingestion_ts",
    "_ingestion_date",
)


def _long(row: DataFrame, labels: Sequence[str], key: str, value: str) -> DataFrame:
    """A one-row frame of counts as one row per label."""
    pairs = F.array(*[F.struct(F.lit(c).alias(key), F.col(f"`{c}`").alias(value)) for c in labels])
    return row.select(F.explode(pairs).alias("p")).select("p.*")


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    return stack(*[df.agg(n().alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
                   for name, df in frames.items()])


def key_completeness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key column whose value is NULL, blank or a placeholder; one pass."""
    row = df.agg(*[n_if(is_missing(k)).alias(k) for k in keys])
    return _long(row, keys, "column_name", "missing_rows")


def missing_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Like ``key_completeness`` for attribute columns, with the share of rows."""
    row = df.agg(n().alias("__all"), *[n_if(is_missing(c)).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("missing_rows"),
                               rate(F.col(f"`{c}`"), "__all").alias("missing_rate")) for c in cols])
    return row.select(F.explode(pairs).alias("p")).select("p.*")


def duplicate_groups(df: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """Normalised keys that occur more than once, with their row count."""
    for e in keys.values():
        df = df.where(e.isNotNull())
    grouped = df.groupBy(*[e.alias(k) for k, e in keys.items()]).agg(n().alias("row_count"))
    return grouped.where("row_count > 1")


def sum_constraint(
    df: DataFrame, by: Sequence[str], col: str, target: float, tol: float
) -> DataFrame:
    """Groups whose sum of ``col`` misses the target."""
    sums = df.groupBy(*by).agg(F.sum(col).alias("total"))
    return sums.where(F.abs(F.col("total") - F.lit(target)) > tol)


def orphan_counts(
    relations: Mapping[str, tuple[DataFrame, DataFrame, Mapping[str, str]]]
) -> DataFrame:
    """Orphan rows per named relationship ``(child, parent, {child col: parent col})``.

    The child is counted per key first: the join then sees each key once,
    however many rows share it.
    """
    counted = []
    for name, (child, parent, on) in relations.items():
        per_key = child.groupBy(*on).agg(n().alias("__n"))
        lost = orphans(per_key, parent, on).agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("orphan_rows"))
        counted.append(lost.select(F.lit(name).alias("relationship"), "orphan_rows"))
    return stack(*counted)


def lineage_completeness(df: DataFrame, cols: Sequence[str] = LINEAGE) -> DataFrame:
    """Rows without each lineage column, beside all rows; one pass."""
    row = df.agg(n().alias("__all"), *[n_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing_rows"), F.col("__all").alias("total_rows"))
                      for c in cols])
    return row.select(F.explode(pairs).alias("p")).select("p.*")


def gate(checks: Mapping[str, DataFrame]) -> DataFrame:
    """Failing checks only: one row per check whose frame of bad rows is not empty."""
    counted = [df.agg(n().alias("failed_rows")).select(F.lit(name).alias("failed_check"), "failed_rows")
               for name, df in checks.items()]
    return stack(*counted).where("failed_rows > 0")


def reference_conflicts(
    df: DataFrame, keys: Mapping[str, Column], attrs: Sequence[Column]
) -> DataFrame:
    """Normalised keys with more than one set of attribute values."""
    for e in keys.values():
        df = df.where(e.isNotNull())
    grouped = df.groupBy(*[e.alias(k) for k, e in keys.items()]).agg(
        n_distinct(*attrs).alias("value_count")
    )
    return grouped.where("value_count > 1")


def mapping_coverage(
    df: DataFrame, raw: Column, ref: DataFrame, ref_key: str, ref_value: str
) -> DataFrame:
    """MAPPED / UNMAPPED / AMBIGUOUS per raw value.

    The feed is counted per value first; the reference is collapsed per key,
    so the join is between two small frames.
    """
    values = df.select(raw.alias("raw_value")).where("raw_value is not null")
    values = values.groupBy("raw_value").agg(n().alias("record_count"))
    mapped = ref.where(F.col(ref_key).isNotNull()).groupBy(F.col(ref_key).alias("__k")).agg(
        variants(ref_value).alias("mapped_values")
    )
    found = F.col("__k").isNotNull()
    size = F.when(found, F.size("mapped_values")).otherwise(0)
    status = F.when(~found, "UNMAPPED").when(size > 1, "AMBIGUOUS").otherwise("MAPPED")
    return values.join(mapped, values["raw_value"] == mapped["__k"], "left").select(
        "raw_value", "record_count",
        F.concat_ws(",", "mapped_values").alias("mapped_values"),
        size.alias("standard_value_count"), status.alias("mapping_status"),
    )


def profile(
    df: DataFrame, key: str, cols: Sequence[str], file: str | None = None,
    rescued: str | None = None, approx: bool = False,
) -> DataFrame:
    """Totals, distinct keys and missing values per column in one aggregate."""
    out = [n().alias("total_rows"), n_distinct(key, approx=approx).alias("distinct_keys")]
    out += [n_if(is_missing(c)).alias(f"missing_{c}") for c in cols]
    if rescued:
        out.append(n_if(F.col(rescued).isNotNull()).alias("rescued_rows"))
    if file:
        out.append(n_distinct(file, approx=approx).alias("source_files"))
    return df.agg(*out)


def missing_patterns(
    df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), only_incomplete: bool = False
) -> DataFrame:
    """Which columns are missing together, optionally per dimension."""
    gaps = F.concat_ws("+", *[F.when(is_missing(c), F.lit(c)) for c in cols])
    pattern = F.when(gaps == "", "complete").otherwise(gaps)
    out = df.groupBy(*by, pattern.alias("pattern")).agg(n().alias("row_count"))
    return out.where("pattern <> 'complete'") if only_incomplete else out


def key_history(df: DataFrame, key: str, file: str) -> DataFrame:
    """Rows and files per key. Counted per (key, file) first, so a key that
    comes very often is spread over its files before it is brought together;
    the file list is as long as the number of deliveries."""
    per_file = df.where(F.col(key).isNotNull()).groupBy(key, file).agg(n().alias("__n"))
    return per_file.groupBy(key).agg(
        F.sum("__n").alias("row_count"),
        F.count(file).alias("file_count"),
        F.array_sort(F.collect_list(file)).alias("files"),
    )


def key_history_summary(df: DataFrame, key: str, file: str) -> DataFrame:
    per_file = df.where(F.col(key).isNotNull()).groupBy(key, file).agg(n().alias("__n"))
    per_key = per_file.groupBy(key).agg(F.sum("__n").alias("rows"), F.count(file).alias("files"))
    return per_key.agg(
        n().alias("distinct_keys"),
        n_if(F.col("rows") > 1).alias("repeated_keys"),
        n_if(F.col("files") > 1).alias("keys_in_many_files"),
        F.max("rows").alias("max_rows_per_key"),
        F.max("files").alias("max_files_per_key"),
    )


def sequence_duplicates(df: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """Keys delivered more than once at the same sequence."""
    return df.groupBy(*keys, *seq).agg(n().alias("row_count")).where("row_count > 1")


class Relation(NamedTuple):
    """How a child refers to a parent; ``mismatch`` pairs must agree when both are known. ``unique``
    states that the parent has one row per key; otherwise it is brought down to one, the greatest."""

    name: str
    parent: DataFrame
    on: Mapping[str, str]
    mismatch: Mapping[str, str] = {}
    split_nulls: bool = False
    unique: bool = False


def relation_profile(child: DataFrame, relations: Sequence[Relation]) -> DataFrame:
    """Missing, unknown and mismatching references of each relation, and rows of which all
    relations are there and agree, in one pass."""
    joined, aggs, sound = child, [], F.lit(True)
    for r in relations:
        parent = r.parent if r.unique else dedupe_latest(r.parent, list(r.on.values()), [])
        joined = lookup(joined, parent, r.on, r.split_nulls)
        present = F.lit(True)
        for c in r.on:
            present = present & F.col(c).isNotNull()
        found = F.col(next(iter(r.on.values()))).isNotNull()
        aggs += [n_if(~present).alias(f"{r.name}_missing"),
                 n_if(present & ~found).alias(f"{r.name}_unknown")]
        sound = sound & present & found
        for c, p in r.mismatch.items():
            aggs.append(n_if(F.col(c) != F.col(p)).alias(f"{r.name}_{c}_mismatch"))
            sound = sound & ~F.coalesce(F.col(c) != F.col(p), F.lit(False))
    return joined.agg(n().alias("total_rows"), *aggs, n_if(sound).alias("all_valid_rows"))


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Row count per pair of values, NULL included."""
    return df.groupBy(a, b).agg(n().alias("row_count"))


def order_profile(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """For each ``(earlier, later)`` pair: rows with both, and rows in the wrong order."""
    labels = [f"{a}>{b}" for a, b in pairs]
    row = df.agg(
        *[n_if(F.col(a).isNotNull() & F.col(b).isNotNull()).alias(f"k{i}") for i, (a, b) in enumerate(pairs)],
        *[n_if(F.col(a) > F.col(b)).alias(f"v{i}") for i, (a, b) in enumerate(pairs)],
    )
    items = F.array(*[F.struct(F.lit(l).alias("pair"), F.col(f"k{i}").alias("comparable_rows"),
                               F.col(f"v{i}").alias("violations")) for i, l in enumerate(labels)])
    return row.select(F.explode(items).alias("p")).select("p.*")


def domain(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Row count per value of each column. One scan: a row becomes one (column,
    value) pair per column, which the map side already counts."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                      for c in cols])
    exploded = df.select(F.explode(pairs).alias("p")).select("p.*")
    return exploded.groupBy("column_name", "value").agg(n().alias("row_count"))


def dq_impact(validated: DataFrame) -> DataFrame:
    """Valid and invalid rows, shares, rows with several failures."""
    bad = F.size(FAILURES)
    row = validated.agg(
        n().alias("total_rows"), n_if(bad == 0).alias("valid_rows"), n_if(bad > 0).alias("invalid_rows"),
        n_if(bad > 1).alias("multi_failure_rows"), F.max(bad).alias("max_failures_per_row"),
    )
    return row.withColumns({
        "valid_pct": F.round(100.0 * rate("valid_rows", "total_rows"), 2),
        "invalid_pct": F.round(100.0 * rate("invalid_rows", "total_rows"), 2),
    })


def dq_breakdown(validated: DataFrame) -> DataFrame:
    """Failed rows per rule."""
    return (validated.select(F.explode(FAILURES).alias("failure_reason"))
            .groupBy("failure_reason").agg(n().alias("failed_records")))


def dq_combinations(validated: DataFrame) -> DataFrame:
    """Failed rows per exact combination of rules."""
    return (validated.where(F.size(FAILURES) > 0)
            .groupBy(F.array_join(FAILURES, ";").alias("failure_combination"))
            .agg(n().alias("failed_records")))


def quarantine_check(rejected: DataFrame, file: str = "_source_file_name") -> DataFrame:
    """Every rejected row must state a reason."""
    return rejected.agg(
        n().alias("quarantine_rows"),
        n_if(is_missing("dq_failure_reasons")).alias("missing_reason_rows"),
        n_distinct(file).alias("affected_files"),
    )


class Layers(NamedTuple):
    """The frames of one entity; ``log`` (accepted changes) and ``kept`` only for type 2 entities:
    ``kept`` is what ``conservation`` found for them."""

    bronze: DataFrame
    silver: DataFrame
    quarantine: DataFrame
    kept: DataFrame | None = None


def conservation(history: DataFrame, log: DataFrame, keys: Sequence[str], sequence: Sequence[str],
                 track_except: Sequence[str] = (), drop: Sequence[str] = (), hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """One row: what became of every accepted change, counted without trusting the history.

    The log is reduced to the greatest row of each key and sequence, as in ``scd2``, and that to a digest of its
    tracked columns; the versions it must give are formed from the digests alone. Per key, their number and an order-independent digest over (start, state) must
    be those of the history. ``repeated_rows`` came again under the same sequence, ``unchanged_rows``
    agreed with what was known, ``expected_versions`` opened one.
    """
    tracked = [c for c in log.columns if c not in {*keys, *sequence, *track_except, *drop}]

    def digests(df: DataFrame, start: Column) -> DataFrame:
        each = F.xxhash64(start, F.col("__state"))
        return df.groupBy(*keys).agg(n().alias("__n"), F.bit_xor(each).alias("__x"), F.sum(each.cast("decimal(38,0)")).alias("__s"))

    # with its place in the hash, a NULL is told from the next column's
    state = F.xxhash64(*[x for c in tracked for x in (F.col(c), F.col(c).isNull())]).alias("__state")
    tops = log.groupBy(*keys, *sequence).agg(n().alias("__n"), F.max(F.struct(*tracked)).alias("__top"))
    rows = tops.select(*keys, *sequence, "__n", "__top.*").select(*keys, *sequence, "__n", state)
    slim = rows.drop("__n")
    given = history.select(*keys, state, F.col(START))
    want = digests(scd2(slim, keys, sequence, hot_rows=hot_rows, unique=True), F.col(START))
    have = digests(given, F.col(START)).toDF(*[f"__h_{k}" for k in keys], "__hn", "__hx", "__hs")
    same = reduce(and_, [want[k].eqNullSafe(have[f"__h_{k}"]) for k in keys])
    both = want.join(have, same, "full_outer")
    agree = (F.col("__n") == F.col("__hn")) & (F.col("__x") == F.col("__hx")) & (F.col("__s") == F.col("__hs"))
    found = both.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("expected_versions"),
        n_if(F.col("__hn").isNull()).alias("lost_keys"), n_if(F.col("__n").isNull()).alias("unknown_keys"),
        n_if(F.col("__n").isNotNull() & F.col("__hn").isNotNull() & ~agree).alias("changed_keys"))
    counts = rows.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("accepted_rows"), n().alias("__distinct"))
    # two single rows, brought together without a join
    both = counts.unionByName(found, allowMissingColumns=True)
    out = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return out.select(
        "accepted_rows", (F.col("accepted_rows") - F.col("__distinct")).alias("repeated_rows"),
        (F.col("__distinct") - F.col("expected_versions")).alias("unchanged_rows"),
        "expected_versions", "lost_keys", "unknown_keys", "changed_keys")


def reconcile(entities: Mapping[str, Layers], key: str = "subject_id") -> DataFrame:
    """Bronze against silver plus quarantine per entity.

    A type 2 history rightly holds fewer rows than were accepted: ``collapsed_records`` are the accepted
    changes that open no version, counted from the change log (see ``conservation``). ``balanced_flag``
    allows them, and fails where the history lacks a version the log gives or has another;
    ``reconciled_flag`` allows none. ``current_records`` and ``distinct_keys`` (of ``key``) describe the history.
    """
    rows = []
    for name, e in entities.items():
        tagged = [("bronze_records", e.bronze), ("silver_records", e.silver),
                  ("quarantined_records", e.quarantine)]
        counts = [df.agg(n().alias("__n")).select(F.lit(layer).alias("__layer"), "__n") for layer, df in tagged]
        if e.kept is not None:
            wrong = F.col("lost_keys") + F.col("unknown_keys") + F.col("changed_keys")
            values = {"collapsed_records": F.col("repeated_rows") + F.col("unchanged_rows"), "__wrong": wrong}
            counts.append(e.kept.select(F.explode(F.array(*[F.struct(F.lit(k).alias("__layer"), v.alias("__n"))
                                                            for k, v in values.items()])).alias("p")).select("p.*"))
            current = e.silver.agg(n_if(F.col(END).isNull()).alias("current_records"), n_distinct(key).alias("distinct_keys"))
            counts.append(_long(current, ["current_records", "distinct_keys"], "__layer", "__n"))
        rows += [df.withColumn("source_entity", F.lit(name)) for df in counts]
    layers = ("bronze_records", "silver_records", "quarantined_records", "collapsed_records", "current_records", "distinct_keys",
              "__wrong")
    wide = stack(*rows).groupBy("source_entity").agg(
        *[F.sum(F.when(F.col("__layer") == layer, F.col("__n"))).alias(layer) for layer in layers]
    )
    wide = wide.withColumn("collapsed_records", F.coalesce("collapsed_records", F.lit(0)))
    return wide.withColumns({
        "quarantine_rate": rate("quarantined_records", "bronze_records"),
        "reconciled_flag": F.col("bronze_records") == F.col("silver_records") + F.col("quarantined_records"),
        "balanced_flag": (F.col("bronze_records")
                          == F.col("silver_records") + F.col("quarantined_records") + F.col("collapsed_records"))
        & (F.coalesce("__wrong", F.lit(0)) == 0),
    }).drop("__wrong")


def layer_changes(
    before: Mapping[str, DataFrame], after: Mapping[str, DataFrame], key: str, delivery: str | None = None
) -> DataFrame:
    """What a delivery changed: the multiset difference of two states of each layer by key.

    One row per layer and key whose number of rows is not what it was, with both numbers; ``change``
    is ``new``, ``lost`` or ``more`` / ``fewer`` where both states have some. ``moved_from`` names the
    layers that lost rows of the key as this one gained some. ``delivery`` is a column told apart as well,
    such as the source file. Rows are counted per key before the states meet.
    """
    by = [key] if delivery is None else [key, delivery]
    counted = [df.groupBy(*by).agg(n().alias("rows")).select(F.lit(layer).alias("layer"), *by, F.lit(when).alias("__when"), "rows")
               for when, state in (("before", before), ("after", after)) for layer, df in state.items()]
    wide = stack(*counted).groupBy("layer", *by).agg(
        *[F.coalesce(F.sum(F.when(F.col("__when") == w, F.col("rows"))), F.lit(0)).alias(f"rows_{w}") for w in ("before", "after")])
    was, now = F.col("rows_before"), F.col("rows_after")
    change = F.when(was == 0, "new").when(now == 0, "lost").when(now > was, "more").otherwise("fewer")
    changed = wide.where(was != now).withColumn("change", change)
    left = changed.where(now < was).groupBy(*[F.col(c).alias(f"__{c}") for c in by]).agg(
        F.concat_ws(",", F.array_sort(F.collect_set("layer"))).alias("__left"))
    same = reduce(and_, [changed[c].eqNullSafe(left[f"__{c}"]) for c in by])
    return changed.join(left, same, "left").select(
        "layer", *by, "rows_before", "rows_after", "change", F.when(now > was, F.col("__left")).alias("moved_from"))


def assert_domain(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Re-assert rules over a trusted table: every count must be 0. The first row counts all rows."""
    row = df.agg(n().alias("total_rows"), *[n_if(r.fails).alias(r.name) for r in rules])
    return _long(row, ["total_rows", *[r.name for r in rules]], "rule", "violations")


def trace(keys: DataFrame, layers: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Rows per wanted key in each layer; ``layers`` all carry ``key``."""
    wanted = keys.select(key).distinct()
    return stack(*[
        df.join(wanted, key, "left_semi").groupBy(key).agg(n().alias("row_count"))
        .withColumn("layer", F.lit(name))
        for name, df in layers.items()
    ])


def parse_coverage(df: DataFrame, col: str, fmt: str | None = None) -> DataFrame:
    """How well a text column parses as a date."""
    parsed = parse_date(col, fmt)
    return df.agg(
        n().alias("total_rows"),
        n_if(is_missing(col)).alias("missing_rows"),
        n_if(~is_missing(col) & parsed.isNull()).alias("unparseable_rows"),
        F.min(parsed).alias("min_date"), F.max(parsed).alias("max_date"),
    )


def conversion_coverage(
    df: DataFrame, key: str, value: str = "result_value", unit: str = "result_unit",
    factor: str = "conversion_factor", out: str = "standardized_result_value",
) -> DataFrame:
    """Measurements that found no unit mapping, were converted, or failed to convert."""
    value_, factor_ = F.col(value), F.col(factor)
    complete = value_.isNotNull() & F.col(unit).isNotNull()
    return df.agg(
        n().alias("total_rows"), n_distinct(key).alias("distinct_keys"),
        n_if(complete & factor_.isNull()).alias("unmapped_complete_measurements"),
        n_if(factor_ != 1).alias("converted_measurements"),
        n_if(value_.isNotNull() & factor_.isNotNull() & F.col(out).isNull()).alias("failed_standardizations"),
    )
