"""Written raw and trusted tables of the derived feeds.

Queries read the tables of the layer before, as in a real installation, and
not one long plan from the test tables. Each table is written once per session
and data folder, under the shared folder of the session.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dqlake.operators import quarantine, valid_rows
from dqlake.plans import gold, silver
from dqlake.sources import new_folder

from .feeds import AS_OF, feed, references

_stores: dict[tuple[str, str], Store] = {}


class Store:
    """Raw, validated, trusted and spine tables of one data folder."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf
        self.root = new_folder(spark, "trusted")
        self._done: set[str] = set()

    def _table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        path = f"{self.root}/{name}"
        if name not in self._done:
            build().write.mode("overwrite").parquet(path)
            self._done.add(name)
        return self.spark.read.parquet(path)

    def kept(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table that one query alone needs written."""
        return self._table(name, build)

    def feed(self, name: str) -> DataFrame:
        """The raw table of a feed."""
        return self._table(f"raw_{name}", lambda: feed(self.spark, self.sf, name))

    def references(self) -> dict[str, DataFrame]:
        return references(self.spark, self.sf)

    def subjects(self) -> DataFrame:
        return self._table("subjects_validated", lambda: silver.validate_subjects(
            self.feed("subjects"), self.references()))

    def history(self) -> DataFrame:
        return self._table("subjects", lambda: silver.subject_history(valid_rows(self.subjects())))

    def visits(self) -> DataFrame:
        return self._table("visits_validated", lambda: silver.validate_visits(
            self.feed("visits"), self.references(), self.history()))

    def adverse_events(self) -> DataFrame:
        return self._table("adverse_events_validated", lambda: silver.validate_adverse_events(
            self.feed("adverse_events"), self.references(), self.history()))

    def labs(self) -> DataFrame:
        return self._table("labs_validated", lambda: silver.validate_labs(
            self.feed("labs"), self.references(), self.history(), valid_rows(self.visits())))

    def validated(self, name: str) -> DataFrame:
        return getattr(self, name)()

    def valid(self, name: str) -> DataFrame:
        return valid_rows(self.validated(name))

    def rejected(self, name: str) -> DataFrame:
        return quarantine(self.validated(name), as_of())

    def spine(self) -> DataFrame:
        return self._table("spine", lambda: gold.subject_spine(self.history(), as_of()))


def as_of() -> Column:
    return F.lit(date.fromisoformat(AS_OF))


def store(spark: SparkSession, sf: str) -> Store:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _stores:
        _stores[key] = Store(spark, sf)
    return _stores[key]
