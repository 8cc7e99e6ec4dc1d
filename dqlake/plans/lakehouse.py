"""The whole run over a landing folder: raw, trusted and metric tables as Parquet."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from dqlake.functions import stamp
from dqlake.operators import Layers, conservation
from dqlake.session import configure
from dqlake.sources import ingest_feed, ingest_snapshot, read_feed
from dqlake.streaming import (
    apply_changes, read_history, read_quarantine, read_reissued, read_valid, release, route_feed,
)

from . import gold, schemas as s, silver

# Raw columns stored as numbers; what does not fit is rescued.
RAW_TYPES = {
    "subjects": {"age": "int"},
    "visits": {"visit_number": "int", "days_from_baseline": "int"},
    "lab_results": {"result_value": "double", "reference_low": "double",
                    "reference_high": "double"},
    "adverse_events": {},
}


# Id of each fact feed, and the rules that fail while a parent is missing.
FACTS = {
    "visits": ("visit_id", {"unknown_silver_subject": "subject_id"}),
    "adverse_events": ("ae_id", {"unknown_silver_subject": "subject_id"}),
    "lab_results": ("lab_result_id", {"unknown_silver_subject": "subject_id", "unknown_silver_visit": "visit_id"}),
}


class Lakehouse:
    """Paths and steps of one installation.

    ``landing`` holds the delivered files, ``root`` the tables and checkpoints;
    both must be visible to every executor. ``folders`` overrides where below
    ``landing`` a table's files lie. ``run`` does the steps in order. Each step
    can be repeated and takes only what is new.
    """

    def __init__(self, spark: SparkSession, landing: str, root: str, as_of: date,
                 folders: Mapping[str, str] | None = None):
        self.spark = configure(spark)
        self.landing, self.root = landing.rstrip("/"), root.rstrip("/")
        self.as_of = F.lit(as_of)
        self.folders = dict(folders or {})

    def _source(self, name: str) -> str:
        spec = s.MASTERS.get(name) or s.FEEDS[name]
        return f"{self.landing}/{self.folders.get(name, spec.folder)}"

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))

    def _checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"

    def bronze(self, name: str) -> DataFrame:
        if name in s.MASTERS:
            return self.read("bronze", s.BRONZE_NAMES[name])
        return read_feed(self.spark, self.path("bronze", s.BRONZE_NAMES[name]), s.FEEDS[name].columns, RAW_TYPES[name])

    def ingest(self) -> None:
        """Masters are read whole, feeds file by file, each file once."""
        for name, spec in s.MASTERS.items():
            ingest_snapshot(self.spark, self._source(name), spec.columns,
                            self.path("bronze", s.BRONZE_NAMES[name]), self.as_of)
        for name, feed in s.FEEDS.items():
            table = s.BRONZE_NAMES[name]
            ingest_feed(self.spark, self._source(name), feed.columns,
                        self.path("bronze", table), self._checkpoint(f"bronze_{table}"),
                        self.as_of, RAW_TYPES[name])

    def build_dimensions(self) -> None:
        raw = {name: self.bronze(name) for name in s.MASTERS}
        for name, df in silver.dimensions(raw).items():
            df.write.mode("overwrite").parquet(self.path("silver", name))

    def dimensions(self) -> dict[str, DataFrame]:
        return {name: self.read("silver", name) for name in s.MASTERS}

    def _route(self, name: str, validated, **options) -> None:
        table = self.path("bronze", s.BRONZE_NAMES[name])
        stream = self.spark.readStream.schema(self.bronze(name).schema).parquet(f"{table}/batch_id=*")
        route_feed(stream, validated, self.path("routed", name), self._checkpoint(f"route_{name}"), **options)

    def valid(self, name: str) -> DataFrame:
        """Accepted rows of a feed."""
        return read_valid(self.spark, self.path("routed", name))

    def quarantine(self, name: str) -> DataFrame:
        return read_quarantine(self.spark, self.path("routed", name), self.as_of)

    def history(self) -> DataFrame:
        return read_history(self.spark, self.path("silver", "subjects"))

    def silver(self, name: str) -> DataFrame:
        """Trusted table of a feed: the history for subjects, accepted rows otherwise."""
        if name == "subjects":
            return self.history()
        rows = self.valid(name)
        if name in ("adverse_events", "lab_results"):
            rows = stamp(rows, "_silver_processed_ts", self.as_of)
        return rows

    def route_subjects(self) -> None:
        self._route("subjects", lambda b: silver.validate_subjects(b, self.dimensions()))
        accepted = self.valid("subjects")
        changes = (
            self.spark.readStream.schema(accepted.schema)
            .parquet(f"{self.path('routed', 'subjects')}/batch_id=*/_is_valid=true")
        )
        apply_changes(
            self.spark, changes, ["subject_id"], log=self.path("silver", "subject_changes"),
            history=self.path("silver", "subjects"), checkpoint=self._checkpoint("subject_history"),
            **silver.SUBJECT_HISTORY,
        )

    def _checked(self, name: str):
        """The validation of a fact feed against what is trusted now."""
        if name == "visits":
            return lambda b: silver.validate_visits(b, self.dimensions(), self.history())
        if name == "adverse_events":
            return lambda b: silver.validate_adverse_events(b, self.dimensions(), self.history())
        return lambda b: silver.validate_labs(b, self.dimensions(), self.history(), self.valid("visits"))

    def route_facts(self) -> None:
        """Facts after subjects, labs after visits: each trusts what came before. First what waited
        for a subject or visit that has come since is tested again."""
        for name, (key, waits) in FACTS.items():
            keys = {"unknown_silver_subject": self.history().select("subject_id")}
            if "unknown_silver_visit" in waits:
                keys["unknown_silver_visit"] = self.valid("visits").select("visit_id")
            release(self.spark, self.path("routed", name), self.bronze(name), keys, self._checked(name))
            self._route(name, self._checked(name), key=key, waits=waits)

    def reissued(self, name: str) -> DataFrame:
        """Accepted rows of a fact feed whose id was accepted before, by batch."""
        return read_reissued(self.spark, self.path("routed", name))

    def layers(self) -> dict[str, Layers]:
        kept = conservation(self.history(), self.valid("subjects"), ["subject_id"], **silver.SUBJECT_HISTORY)
        return {
            name: Layers(self.bronze(name), self.silver(name), self.quarantine(name), kept if name == "subjects" else None)
            for name in s.FEEDS
        }

    def build_gold(self) -> None:
        history, day = self.history(), self.as_of
        visits, events, labs = (self.silver(n) for n in ("visits", "adverse_events", "lab_results"))

        def write(name: str, df: DataFrame) -> None:
            df.write.mode("overwrite").parquet(self.path("gold", name))

        write("subject_spine", gold.subject_spine(history, day))
        spine = self.read("gold", "subject_spine")
        write("subject_summary", gold.subject_summary(spine, visits, events, labs, day))
        write("subject_disposition", gold.subject_disposition(spine, day))
        write("discontinuation_reasons", gold.discontinuation_reasons(spine, day))
        write("enrollment_timeseries", gold.enrollment_timeseries(spine, day))
        write("site_performance",
              gold.site_performance(spine, visits, events, labs, history, day))
        write("visit_compliance", gold.visit_compliance(visits, day))
        write("safety_metrics", gold.safety_metrics(events, spine, day))
        write("lab_monitoring", gold.lab_monitoring(labs, history, day))
        rejected = {name: self.quarantine(name) for name in s.FEEDS}
        write("data_quality_metrics", gold.data_quality_metrics(rejected, history, day))
        write("reconciliation", gold.reconciliation(self.layers(), day))

    def run(self) -> None:
        self.ingest()
        self.build_dimensions()
        self.route_subjects()
        self.route_facts()
        self.build_gold()
