"""Raw columns of the clinical sources, and the types of the trusted tables."""

from __future__ import annotations

from typing import NamedTuple


class Feed(NamedTuple):
    """A dated change or event feed: ``folder`` below the landing root."""

    folder: str
    columns: tuple[str, ...]


# Column names as delivered.
FEEDS = {
    "subjects": Feed("edc/subjects", (
        "subject_id", "study_id", "site_id", "screening_date", "enrollment_date",
        "subject_status", "age", "sex", "baseline_condition_code", "arm_code",
        "randomization_date", "informed_consent_date", "discontinuation_date",
        "discontinuation_reason")),
    "visits": Feed("edc/visits", (
        "visit_id", "subject_id", "study_id", "site_id", "visit_name", "visit_number",
        "visit_date", "visit_status", "days_from_baseline")),
    "lab_results": Feed("lab/lab_results", (
        "lab_result_id", "subject_id", "study_id", "visit_id", "lab_test_code", "lab_test_name",
        "result_value", "result_unit", "reference_low", "reference_high", "abnormal_flag",
        "collection_date", "lab_vendor")),
    "adverse_events": Feed("safety/adverse_events", (
        "ae_id", "subject_id", "study_id", "site_id", "ae_term", "meddra_soc", "severity",
        "serious_flag", "onset_date", "resolution_date", "outcome", "related_to_study_drug",
        "action_taken")),
}


class Master(NamedTuple):
    """A full-refresh table and how its trusted form is made.

    ``keys`` identify a row by their trimmed text, without regard to case if
    ``fold``; mapping tables keep case variants, which their use collapses.
    ``upper`` columns are categories; ``types`` are safe casts.
    """

    folder: str
    columns: tuple[str, ...]
    keys: tuple[str, ...]
    upper: tuple[str, ...] = ()
    types: dict[str, str] = {}
    fold: bool = False


# Column names as delivered, business keys and types.
MASTERS = {
    "dim_institution": Master("master/institutions", (
        "institution_id", "institution_name", "city", "country", "region"), ("institution_id",)),
    "dim_sponsor": Master("master/sponsors", (
        "sponsor_id", "sponsor_name", "sponsor_type", "hq_country", "hq_city"), ("sponsor_id",)),
    "dim_product": Master("master/products", (
        "product_id", "sponsor_id", "product_code", "product_name", "active_ingredient",
        "modality", "mechanism_of_action", "product_status"), ("product_id",)),
    "ref_country_region": Master("reference/country_region.csv", ("country", "region"), ("country",),
                                 fold=True),
    "ref_geography": Master("reference/geography.csv", ("city", "country", "region"),
                            ("city", "country"), fold=True),
    "dim_site": Master("ctms/sites", (
        "site_id", "study_id", "institution_id", "site_name", "country", "city",
        "principal_investigator", "target_subjects", "activation_date", "site_status"),
        ("site_id",), ("site_status",), {"target_subjects": "int", "activation_date": "date"}),
    "dim_study": Master("ctms/studies", (
        "study_id", "study_name", "protocol_number", "therapeutic_area", "phase",
        "indication_code", "sponsor_id", "target_enrollment", "planned_start_date",
        "planned_end_date", "study_status", "protocol_version"),
        ("study_id",), ("study_status",),
        {"target_enrollment": "int", "planned_start_date": "date", "planned_end_date": "date"}),
    "dim_study_arm": Master("protocol/study_arms", (
        "study_id", "arm_code", "arm_label", "product_id", "product_role", "dose", "dose_unit",
        "dosing_schedule", "planned_allocation_pct"), ("study_id", "arm_code"), (),
        {"dose": "int", "planned_allocation_pct": "int"}),
    "ref_diagnosis": Master("reference/diagnosis_mapping.csv", (
        "diagnosis_code", "diagnosis_description"), ("diagnosis_code",)),
    "ref_lab_test": Master("reference/lab_test_reference.csv", (
        "lab_test_code", "lab_test_name", "standard_unit", "reference_low", "reference_high"),
        ("lab_test_code",), (), {"reference_low": "double", "reference_high": "double"}),
    "ref_severity": Master("reference/severity_mapping.csv", (
        "raw_severity", "standard_severity", "severity_rank"), ("raw_severity",), (),
        {"severity_rank": "int"}),
    "ref_sex": Master("reference/sex_mapping.csv", ("raw_sex", "standard_sex"), ("raw_sex",)),
    "ref_unit": Master("reference/unit_mapping.csv", (
        "lab_test_code", "raw_unit", "standard_unit", "conversion_factor"),
        ("lab_test_code", "raw_unit"), (), {"conversion_factor": "double"}),
}

# Names of the raw tables.
BRONZE_NAMES = {
    "subjects": "edc_subjects", "visits": "edc_visits", "lab_results": "lab_results",
    "adverse_events": "safety_adverse_events",
    "dim_institution": "master_institutions", "dim_sponsor": "master_sponsors",
    "dim_product": "master_products", "ref_country_region": "ref_country_region",
    "ref_geography": "ref_geography", "dim_site": "ctms_sites", "dim_study": "ctms_studies",
    "dim_study_arm": "protocol_study_arms", "ref_diagnosis": "ref_diagnosis_mapping",
    "ref_lab_test": "ref_lab_test", "ref_severity": "ref_severity_mapping",
    "ref_sex": "ref_sex_mapping", "ref_unit": "ref_unit_mapping",
}

# Status words and limits of the rules.
SUBJECT_STATUSES = ("SCREENING", "ENROLLED", "SCREEN_FAILED", "DISCONTINUED", "COMPLETED")
ARM_STATUSES = ("ENROLLED", "DISCONTINUED", "COMPLETED")
VISIT_STATUSES = ("COMPLETED", "MISSED", "RESCHEDULED")
VISIT_STATUS_WORDS = {
    "COMPLETED": ("COMPLETED", "COMPLETE", "DONE"), "MISSED": ("MISSED",),
    "RESCHEDULED": ("RESCHEDULED",), "UNKNOWN": ("?",),
}
COMPLETED_WORDS = ("COMPLETED", "COMPLETE")
DISCONTINUED_WORDS = ("DISCONTINUED", "WITHDRAWN")
SCREEN_FAILED_WORDS = ("SCREEN FAILED", "SCREEN_FAILED", "SCREEN FAILURE")
AGE_RANGE = (18, 100)
LAB_DATE_FORMAT = "dd-MMM-yyyy"
LINEAGE_UNTRACKED = (
    "_source_file", "_source_file_modification_ts", "_ingestion_ts", "_ingestion_date",
)
