"""Rejected rows that wait for a parent: an index from missing keys to rows, and the test of those rows only."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, functions as F

from .rollup import stack
from .rules import FAILURES

ROW_ID = "_row_id"


def with_row_id(raw: DataFrame) -> DataFrame:
    """Raw rows with a digest of all their columns. Equal rows share it, and their fate."""
    return raw.withColumn(ROW_ID, F.md5(F.to_json(F.struct("*")).cast("binary")))


def waiting_index(rejected: DataFrame, waits: Mapping[str, str]) -> DataFrame:
    """(reason, parent_key, _row_id): rejected rows by the parent they lack. ``waits`` maps a rule that
    fails for want of a parent to the column that holds the parent's key."""
    return stack(*[
        rejected.where(F.array_contains(FAILURES, reason) & F.col(c).isNotNull())
        .select(F.lit(reason).alias("reason"), F.col(c).cast("string").alias("parent_key"), ROW_ID)
        for reason, c in waits.items()
    ])


def arrived(index: DataFrame, parents: Mapping[str, DataFrame]) -> DataFrame:
    """The entries of the index whose parent is there now. ``parents`` holds, per reason, a frame whose
    first column is the parents' keys. Only the index and the keys are read."""
    keys = stack(*[df.select(F.lit(reason).alias("reason"), df[df.columns[0]].cast("string").alias("parent_key"))
                   for reason, df in parents.items()]).where("parent_key is not null").distinct()
    return index.join(keys, ["reason", "parent_key"], "left_semi")


def retest(raw: DataFrame, entries: DataFrame, revalidate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The raw rows of these entries, validated again; ``raw`` carries ``_row_id``."""
    return revalidate(raw.join(entries.select(ROW_ID).distinct(), ROW_ID, "left_semi"))
