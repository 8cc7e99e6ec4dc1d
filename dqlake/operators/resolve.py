"""Deduplication, reference tables and joins.

Join strategy is left to Catalyst and AQE: no side carries a broadcast hint,
so a reference is broadcast only when its measured size allows it and the join
falls back to a shuffle otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

Keys = Sequence[str] | Mapping[str, Column]


def _as_exprs(keys: Keys) -> dict[str, Column]:
    if isinstance(keys, Mapping):
        return dict(keys)
    return {k: F.col(k) for k in keys}


def _sortable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]


def dedupe_latest(
    df: DataFrame, keys: Keys, order_by: Sequence[str], drop_missing: bool = True
) -> DataFrame:
    """One row per key: the latest by ``order_by``, ties broken by every column.

    ``row_number() = 1`` lets Spark drop the losers before the shuffle
    (WindowGroupLimit), so a key with very many rows sends one row per map task.
    """
    exprs = _as_exprs(keys)
    parts = {f"__key_{i}": e for i, e in enumerate(exprs.values())}
    out = df.withColumns(parts)
    if drop_missing:
        for p in parts:
            out = out.where(F.col(p).isNotNull())
    rest = [c for c in _sortable(df) if c not in order_by]
    order = [F.col(c).desc_nulls_last() for c in [*order_by, *rest]]
    w = Window.partitionBy(*parts).orderBy(*order)
    return out.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn", *parts)


def first_by(df: DataFrame, keys: Keys) -> DataFrame:
    """One row per key, chosen by the full row so that reruns agree."""
    return dedupe_latest(df, keys, [], drop_missing=False)


def rank_within(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], limit: int, name: str = "rank"
) -> DataFrame:
    """The first ``limit`` rows of each group with their position.

    The bound is part of the operator: it is what lets Spark cut each group
    before the shuffle, so no task ever holds a whole hot group.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= limit)


def reference(
    df: DataFrame, keys: Mapping[str, Column], attrs: Mapping[str, Column] | None = None
) -> DataFrame:
    """Collapse a reference to one row per normalised key, MAX of each attribute.

    Rows with a missing key part are dropped. Deterministic when each attribute
    depends on the key, which ``reference_conflicts`` verifies.
    """
    attrs = attrs or {}
    cols = [e.alias(k) for k, e in {**keys, **attrs}.items()]
    out = df.select(*cols)
    for k in keys:
        out = out.where(F.col(k).isNotNull())
    if not attrs:
        return out.distinct()
    return out.groupBy(*keys).agg(*[F.max(a).alias(a) for a in attrs])


def key_set(df: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """Distinct non-null keys, for existence checks."""
    return reference(df, keys)


def lookup(df: DataFrame, ref: DataFrame, on: Mapping[str, str], split_nulls: bool = False) -> DataFrame:
    """Left join to a reference that is unique per key: never adds or drops rows.

    ``on`` maps a column of ``df`` to a column of ``ref``. For references too large to broadcast,
    ``split_nulls`` keeps rows with a NULL in their key out of the join, which would bring all of them
    to one task: they can match nothing, and are added after it. ``df`` is then read twice.
    """
    def joined(rows: DataFrame) -> DataFrame:
        cond = reduce(and_, [rows[left] == ref[right] for left, right in on.items()])
        return rows.join(ref, cond, "left")

    if not split_nulls:
        return joined(df)
    keyed = reduce(and_, [F.col(c).isNotNull() for c in on])
    bare = df.where(~keyed).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in ref.schema.fields])
    return joined(df.where(keyed)).union(bare)


def lookup_fallback(
    df: DataFrame,
    levels: Sequence[tuple[DataFrame, Mapping[str, str], str]],
    out: str,
    default: str,
) -> DataFrame:
    """First hit over ordered references ``(ref, on, value)``, else ``default``."""
    keep = df.columns
    joined = df
    for ref, on, _ in levels:
        joined = lookup(joined, ref, on)
    values = [F.col(value) for _, _, value in levels]
    return joined.select(*keep, F.coalesce(*values, F.lit(default)).alias(out))


def inherit(
    df: DataFrame, parent: DataFrame, key: str, cols: Sequence[str], split_nulls: bool = False,
) -> DataFrame:
    """Bring ``cols`` of the parent entity onto each child row.

    ``parent`` must hold one row per ``key``.
    """
    slim = parent.select(F.col(key).alias("__parent_key"), *cols)
    return lookup(df, slim, {key: "__parent_key"}, split_nulls).drop("__parent_key")


def combine_rollups(base: DataFrame, *rollups: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join pre-aggregated facts that share the grain ``on``."""
    for r in rollups:
        base = base.join(r, list(on), "left")
    return base


def orphans(child: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Child rows whose key is present but unknown to the parent."""
    for c in on:
        child = child.where(F.col(c).isNotNull())
    slim = parent.select(*[F.col(p).alias(f"__p_{p}") for p in on.values()])
    cond = None
    for c, p in on.items():
        part = child[c] == slim[f"__p_{p}"]
        cond = part if cond is None else cond & part
    return child.join(slim, cond, "left_anti")


def profile_top(
    df: DataFrame, key: str, n: int, metrics: Mapping[str, Column]
) -> DataFrame:
    """Metrics of the ``n`` most frequent keys (ties by key); rows without a key take no place."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    top = counts.orderBy(F.desc("__n"), F.col(key).asc_nulls_last()).limit(n).select(key)
    return df.join(top, key, "left_semi").groupBy(key).agg(
        *[m.alias(name) for name, m in metrics.items()]
    )


def reissued_keys(batch: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows of a new batch whose key was already accepted earlier, or comes twice in it."""
    seen = target.where(F.col(key).isNotNull()).select(key).distinct()
    seen = seen.withColumn("__seen", F.lit(1))
    per_key = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return (
        per_key.join(seen, key, "left")
        .where((F.col("row_count") > 1) | F.col("__seen").isNotNull())
        .select(key, "row_count", F.col("__seen").isNotNull().alias("in_target"))
    )

