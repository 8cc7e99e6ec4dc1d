"""The whole run over delivered files, then two more deliveries."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from dqlake.functions import normalize_key
from dqlake.operators import END, START, gate, reconcile, reference_conflicts, scd2_check
from dqlake.plans import Lakehouse, silver
from dqlake.sources import landing_inventory

import landing


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    landing.write_landing(root / "landing")
    lake = Lakehouse(spark, str(root / "landing"), str(root / "tables"), date(2026, 9, 30))
    lake.run()
    return lake


def reasons(df, key):
    return {r[key]: r["dq_failure_reasons"] for r in df.select(key, "dq_failure_reasons").collect()}


def test_subject_routing(lake):
    why = reasons(lake.quarantine("subjects"), "subject_id")
    assert why == {
        None: "missing_subject_id", "S-5": "missing_study_id;unknown_site_id;unknown_arm_code",
        "S-6": "age_out_of_range", "S-7": "consent_after_enrollment", "S-8": "unmappable_sex",
        "S-9": "site_not_in_study", "S-10": "invalid_source_snapshot_date"}


def test_history_versions(lake):
    got = {(r.subject_id, str(r[START].source_snapshot_date), r[END] is None, r.subject_status)
           for r in lake.history().collect()}
    assert got == {("S-1", "2026-08-25", True, "ENROLLED"), ("S-2", "2026-08-25", False, "ENROLLED"),
                   ("S-2", "2026-08-27", True, "COMPLETED"), ("S-3", "2026-08-25", True, "SCREENING")}


def test_unchanged_repeat_updates_lineage_only(lake):
    row = lake.history().where("subject_id = 'S-1'").first()
    assert row["_source_file"].endswith("subjects_20260827.csv")


def test_visits(lake):
    assert reasons(lake.quarantine("visits"), "visit_id") == {
        "V-3": "completed_visit_missing_date", "V-4": "unknown_silver_subject;invalid_visit_status",
        "V-5": "site_not_in_study;subject_not_in_study;subject_not_in_site"}
    ok = {r.visit_id: r for r in lake.silver("visits").collect()}
    assert ok["V-1"].visit_status == "COMPLETED" and ok["V-2"].days_from_baseline is None
    assert ok["V-2"]._rescued_data == '{"days_from_baseline":"n/a"}'


def test_labs(lake):
    assert reasons(lake.quarantine("lab_results"), "lab_result_id") == {
        "L-3": "missing_result_value",
        "L-4": "visit_subject_mismatch;unknown_lab_test_code;unmapped_test_unit;invalid_collection_date",
        "L-5": "unknown_silver_visit"}
    ok = {r.lab_result_id: r for r in lake.silver("lab_results").collect()}
    assert (ok["L-1"].standardized_result_value, ok["L-1"].derived_abnormal_flag,
            ok["L-1"].derived_direction, ok["L-1"].abnormal_flag_discrepancy) == (90.0, "N", "NORMAL", False)
    assert (ok["L-2"].derived_abnormal_flag, ok["L-2"].derived_direction,
            ok["L-2"].abnormal_flag_discrepancy) == ("Y", "LOW", True)


def test_adverse_events(lake):
    assert reasons(lake.quarantine("adverse_events"), "ae_id") == {
        "AE-3": "invalid_onset_date", "AE-4": "subject_site_mismatch;site_study_mismatch"}
    ok = {r.ae_id: r for r in lake.silver("adverse_events").collect()}
    assert ok["AE-1"].mild_serious_warning and ok["AE-1"].resolution_before_onset_warning
    assert ok["AE-2"].high_severity_nonserious_warning and ok["AE-2"].fatal_nonserious_warning


def test_dimensions(lake):
    region = {r.site_id: r.region for r in lake.read("silver", "dim_site").collect()}
    assert region == {"101-001": "US East", "101-002": "Europe", "102-001": "UNMAPPED"}
    assert lake.read("silver", "ref_geography").count() == 1
    site = lake.read("silver", "dim_site").where("site_id = '102-001'").first()
    assert (site.target_subjects, site.site_status) == (None, "CLOSED")
    placebo = lake.read("silver", "dim_product").where("product_id = 'PRD-999'").first()
    assert (placebo.sponsor_id, placebo.modality) == (None, "-")
    # Case variants of a raw value stay apart in the mapping and agree in their meaning.
    assert lake.read("silver", "ref_sex").count() == len(landing.MASTER_ROWS["ref_sex"])
    for name, key, value in (("ref_sex", "raw_sex", "standard_sex"), ("ref_severity", "raw_severity", "severity_rank")):
        conflicts = reference_conflicts(lake.read("silver", name), {key: normalize_key(key)}, [F.col(value)])
        assert conflicts.count() == 0


def test_gold(lake):
    spine = {r.subject_id: r for r in lake.read("gold", "subject_spine").collect()}
    assert set(spine) == {"S-1", "S-2", "S-3"}
    assert (spine["S-2"].ever_completed_flag, spine["S-2"].subject_version_count) == (1, 2)
    labs = lake.read("gold", "lab_monitoring").first()
    assert (labs.site_id, labs.low_count, labs.normal_count, labs.abnormal_rate) == ("101-001", 1, 1, 0.5)
    months = lake.read("gold", "enrollment_timeseries").orderBy("month_start").collect()
    assert [m.screened_subjects for m in months] == [3] + [0] * 8
    assert months[-1].cum_enrolled_subjects == 2
    balance = {r.source_entity: r for r in lake.read("gold", "reconciliation").collect()}
    assert all(r.balanced_flag for r in balance.values())
    assert not balance["subjects"].reconciled_flag and balance["subjects"].collapsed_records == 1
    rules = lake.read("gold", "data_quality_metrics")
    assert rules.where("source_entity = 'lab_results' and dq_rule = 'unknown_silver_visit'").first().site_id == "101-001"


def test_validation_runs_inside_a_stream(spark, lake):
    """Stream-static joins and rules without a micro-batch function give the routed rows."""
    bronze = lake.path("bronze", "edc_visits")
    stream = spark.readStream.schema(spark.read.parquet(bronze).schema).parquet(bronze)
    checked = silver.validate_visits(stream, lake.dimensions(), lake.history())
    query = (checked.writeStream.format("memory").queryName("checked_visits").outputMode("append")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    got = spark.table("checked_visits").where("not _is_valid")
    got = {r.visit_id: ";".join(r._dq_failures) for r in got.collect()}
    assert got == reasons(lake.quarantine("visits"), "visit_id")


def test_landing_inventory(spark, lake):
    got = {(r.family, r.dataset): r.file_count for r in landing_inventory(spark, lake.landing).collect()}
    assert got[("edc", "subjects")] == 3 and got[("reference", "sex_mapping")] == 1
    assert len(got) == 17 and sum(got.values()) == 19


def test_next_deliveries(spark, lake):
    """Comes last: it changes the lake."""
    from pathlib import Path
    before = lake.bronze("subjects").count()
    landing.deliver(Path(lake.landing), "subjects", "20260913", landing.GOLDEN)
    landing.deliver(Path(lake.landing), "subjects", "20260820", landing.LATE)
    lake.run()
    assert lake.bronze("subjects").count() == before + len(landing.GOLDEN) + len(landing.LATE)
    why = reasons(lake.quarantine("subjects").where("subject_id like '%DEMO%'"), "subject_id")
    assert why == landing.GOLDEN_REJECTED
    demo = lake.read("gold", "subject_summary").where("subject_id like '%DEMO%'")
    assert {r.subject_id[-2:] for r in demo.collect()} == {"06", "07", "08"}

    # The late file is spliced in front, and the stream agrees with the batch.
    late = lake.history().where("subject_id = 'S-2'").orderBy(START).collect()
    assert [r.subject_status for r in late] == ["SCREENING", "ENROLLED", "COMPLETED"]
    assert [r[END] == n for r, n in zip(late, [*[r[START] for r in late[1:]], None])] == [True] * 3
    batch = silver.subject_history(lake.valid("subjects"))
    same = batch.columns
    assert batch.exceptAll(lake.history().select(*same)).count() == 0
    assert lake.history().select(*same).exceptAll(batch).count() == 0

    check = scd2_check(lake.history(), ["subject_id"]).first()
    assert (check.duplicate_current_keys, check.missing_current_keys, check.invalid_intervals) == (0, 0, 0)
    assert gate({"UNMAPPED": lake.history().where("sex = 'UNMAPPED'"),
                 "NO_KEY": lake.history().where(F.col("subject_id").isNull())}).count() == 0
    assert all(r.balanced_flag for r in reconcile(lake.layers()).collect())


def test_late_parents_and_reissued_ids(spark, lake):
    """Comes after the next deliveries: S-404 appears at last, AE-1 and L-1 come again, a new lab waits for a visit."""
    from pathlib import Path
    root = Path(lake.landing)
    assert "V-4" in reasons(lake.quarantine("visits"), "visit_id")
    before = lake.valid("visits").count()
    landing.deliver(root, "subjects", "20260914", [landing.subject("S-404")])
    landing.deliver(root, "visits", "20260914", [("V-9", "S-405", "101", "101-001", "Baseline", "1", "2026-01-20", "Done", "0")])
    again = landing.FEED_ROWS[("adverse_events", "20260826")][0]
    landing.deliver(root, "adverse_events", "20260914", [again, ("AE-9", *again[1:])])
    lab = landing.FEED_ROWS[("lab_results", "20260826")][0]
    landing.deliver(root, "lab_results", "20260914", [lab, ("L-9", "S-405", "101", "V-9", *lab[4:])])
    for step in (lake.ingest, lake.route_subjects, lake.route_facts):
        step()
    # V-4 also has a status that is none: tested again, and rejected for that alone
    assert reasons(lake.quarantine("visits"), "visit_id")["V-4"] == "invalid_visit_status"
    assert reasons(lake.quarantine("visits"), "visit_id")["V-9"] == "unknown_silver_subject"
    assert lake.valid("visits").count() == before
    assert {r.ae_id: (r.row_count, r.in_target) for r in lake.reissued("adverse_events").collect()} == {"AE-1": (1, True)}
    assert {r.lab_result_id: (r.row_count, r.in_target) for r in lake.reissued("lab_results").collect()} == {"L-1": (1, True)}
    assert reasons(lake.quarantine("lab_results"), "lab_result_id")["L-9"] == "unknown_silver_subject;unknown_silver_visit"

    landing.deliver(root, "subjects", "20260915", [landing.subject("S-405")])
    for step in (lake.ingest, lake.route_subjects, lake.route_facts):
        step()
    assert "V-9" not in reasons(lake.quarantine("visits"), "visit_id")
    assert lake.valid("visits").where("visit_id = 'V-9'").count() == 1
    # the lab is tested after its visit was accepted
    assert "L-9" not in reasons(lake.quarantine("lab_results"), "lab_result_id")
    assert lake.valid("lab_results").where("lab_result_id = 'L-9'").count() == 1
    for name in ("visits", "lab_results", "adverse_events"):
        assert lake.bronze(name).count() == lake.valid(name).count() + lake.quarantine(name).count()
    assert all(r.balanced_flag for r in reconcile(lake.layers()).collect())
