"""Trusted clinical tables: references, validated feeds, subject history.

Every function takes DataFrames and returns one; the same code runs on batch
tables and inside a stream's micro-batch.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from dqlake.functions import (
    blank_to_null, delivery_date, map_flag, map_values, normalize_category, normalize_key,
    parse_date, standardise, typed,
)
from dqlake.operators import (
    dedupe_latest, key_set, lookup, lookup_fallback, reference, scd2, validate, warn,
)
from dqlake.operators import rules as r
from dqlake.operators.waiting import ROW_ID
from dqlake.sources import RESCUED

from . import schemas as s

LINEAGE = ["_source_file", "_source_file_name", "_source_file_modification_ts", "_ingestion_ts",
           "_ingestion_date"]
ROUTING = ["_dq_failures", "_is_valid"]

Tables = Mapping[str, DataFrame]


def _identity(raw: DataFrame) -> list[str]:
    """The column that tells raw rows apart, where a routed feed has added it."""
    return [c for c in raw.columns if c == ROW_ID]


# --- dimensions and references -------------------------------------------------

def dimension(raw: DataFrame, spec: s.Master) -> DataFrame:
    """Latest row per key, trimmed and typed. Keys and ids are normalised as facts normalise them;
    raw values of a mapping keep their case variants, which its use collapses.

    A refresh stamps all its rows alike, so the file name decides before the
    remaining columns do.
    """
    ids = {c for c in spec.columns if c.endswith("_id") or (c in spec.keys and not spec.fold and not c.startswith("raw_"))}
    clean = raw.withColumns({c: normalize_key(c) if c in ids else blank_to_null(c) if c in spec.keys else F.trim(c)
                             for c in spec.columns})
    keys = {k: F.upper(k) if spec.fold else F.col(k) for k in spec.keys}
    latest = dedupe_latest(clean, keys, ["_ingestion_ts", "_source_file_name"])
    latest = latest.withColumns({c: F.upper(c) for c in spec.upper})
    return typed(latest, spec.types).select(*spec.columns, *LINEAGE)


def with_region(sites: DataFrame, geography: DataFrame, countries: DataFrame) -> DataFrame:
    """Region of a site by city and country, else by country, else UNMAPPED."""
    geo = reference(geography, {"_g_city": normalize_key("city"), "_g_country": normalize_key("country")},
                    {"_g_region": F.col("region")})
    land = reference(countries, {"_c_country": normalize_key("country")}, {"_c_region": F.col("region")})
    keyed = sites.withColumns({"_city": normalize_key("city"), "_country": normalize_key("country")})
    out = lookup_fallback(keyed, [
        (geo, {"_city": "_g_city", "_country": "_g_country"}, "_g_region"),
        (land, {"_country": "_c_country"}, "_c_region"),
    ], "region", "UNMAPPED")
    return out.drop("_city", "_country")


def dimensions(bronze: Tables) -> dict[str, DataFrame]:
    """The 13 dimension and reference tables."""
    out = {name: dimension(bronze[name], spec) for name, spec in s.MASTERS.items()}
    out["dim_site"] = with_region(out["dim_site"], out["ref_geography"], out["ref_country_region"])
    return out


def sex_ref(t: Tables) -> DataFrame:
    return reference(t["ref_sex"], {"_sex_key": normalize_key("raw_sex")},
                     {"_standard_sex": normalize_category("standard_sex")})


def diagnosis_ref(t: Tables) -> DataFrame:
    return reference(t["ref_diagnosis"], {"_dx_code": normalize_key("diagnosis_code")},
                     {"_dx_description": blank_to_null("diagnosis_description")})


def severity_ref(t: Tables) -> DataFrame:
    return reference(t["ref_severity"], {"_severity_key": normalize_key("raw_severity")},
                     {"_standard_severity": normalize_category("standard_severity"),
                      "_severity_rank": F.col("severity_rank").try_cast("int")})


def study_keys(t: Tables) -> DataFrame:
    return key_set(t["dim_study"], {"_study_key": normalize_key("study_id")})


def site_ref(t: Tables) -> DataFrame:
    return reference(t["dim_site"], {"_site_key": normalize_key("site_id")},
                     {"_site_study": normalize_key("study_id")})


def arm_keys(t: Tables) -> DataFrame:
    return key_set(t["dim_study_arm"], {"_arm_study": normalize_key("study_id"),
                                        "_arm_key": normalize_key("arm_code")})


def lab_test_ref(t: Tables) -> DataFrame:
    return reference(t["ref_lab_test"], {"_test_key": normalize_key("lab_test_code")},
                     {"_test_unit": blank_to_null("standard_unit"),
                      "_test_low": F.col("reference_low").try_cast("double"),
                      "_test_high": F.col("reference_high").try_cast("double")})


def unit_ref(t: Tables) -> DataFrame:
    return reference(t["ref_unit"], {"_unit_test": normalize_key("lab_test_code"),
                                     "_unit_key": normalize_key("raw_unit")},
                     {"_unit_standard": blank_to_null("standard_unit"),
                      "_factor": F.col("conversion_factor").try_cast("double")})


def trusted_subjects(history: DataFrame) -> DataFrame:
    """Open version of each subject. The history has one per key by construction,
    so no further collapse is needed."""
    return history.where(F.col("__END_AT").isNull()).select(
        F.col("subject_id").alias("_subject_key"), F.col("study_id").alias("_subject_study"),
        F.col("site_id").alias("_subject_site"),
    )


def trusted_visits(visits: DataFrame) -> DataFrame:
    """One row per accepted visit id; a reissued id must not multiply lab rows."""
    return reference(visits, {"_visit_key": F.col("visit_id")},
                     {"_visit_subject": F.col("subject_id"), "_visit_study": F.col("study_id")})


# --- subjects ------------------------------------------------------------------

def subject_rules() -> list[r.Rule]:
    """The 19 blocking rules, in reporting order."""
    return [
        r.missing("missing_subject_id", "subject_id"),
        r.missing("missing_study_id", "study_id"),
        r.unknown("unknown_study_id", "study_id", "_study_key"),
        r.missing("missing_site_id", "site_id"),
        r.unknown("unknown_site_id", "site_id", "_site_key"),
        r.mismatch("site_not_in_study", "study_id", "_site_study"),
        r.between("age_out_of_range", "age", *s.AGE_RANGE),
        r.unknown("unmappable_sex", "_sex", "_standard_sex"),
        r.unknown("unknown_baseline_condition", "baseline_condition_code", "_dx_code"),
        r.missing("invalid_source_snapshot_date", "source_snapshot_date"),
        r.missing("missing_screening_date", "screening_date"),
        r.before("enrollment_before_screening", "enrollment_date", "screening_date"),
        r.before("consent_after_enrollment", "enrollment_date", "informed_consent_date"),
        r.before("randomization_before_enrollment", "randomization_date", "enrollment_date"),
        r.before("discontinuation_before_enrollment", "discontinuation_date", "enrollment_date"),
        r.before("discontinuation_before_randomization", "discontinuation_date",
                 "randomization_date"),
        r.not_in("invalid_subject_status", "subject_status", s.SUBJECT_STATUSES),
        r.required_when("enrolled_without_arm",
                        F.col("subject_status").isin(*s.ARM_STATUSES), "arm_code"),
        r.unknown("unknown_arm_code", "arm_code", "_arm_key"),
    ]


SUBJECT_COLUMNS = [
    "subject_id", "study_id", "site_id", "screening_date", "enrollment_date", "subject_status",
    "age", "sex", "baseline_condition_code", "baseline_condition", "arm_code",
    "randomization_date", "informed_consent_date", "discontinuation_date",
    "discontinuation_reason",
]


def validate_subjects(raw: DataFrame, t: Tables) -> DataFrame:
    """Typed, resolved and rule-checked subject changes."""
    clean = raw.withColumns({
        "source_snapshot_date": delivery_date("_source_file_name", "subjects"),
        **{c: normalize_key(c) for c in (
            "subject_id", "study_id", "site_id", "arm_code", "subject_status",
            "baseline_condition_code", "discontinuation_reason")},
        "_sex": normalize_category("sex"),
    })
    clean = typed(clean, {"age": "int", **{c: "date" for c in (
        "screening_date", "enrollment_date", "randomization_date", "informed_consent_date",
        "discontinuation_date")}})
    found = lookup(clean, sex_ref(t), {"_sex": "_sex_key"})
    found = lookup(found, diagnosis_ref(t), {"baseline_condition_code": "_dx_code"})
    found = lookup(found, study_keys(t), {"study_id": "_study_key"})
    found = lookup(found, site_ref(t), {"site_id": "_site_key"})
    found = lookup(found, arm_keys(t), {"study_id": "_arm_study", "arm_code": "_arm_key"})
    # A given but unmapped value stays visible; a missing one stays missing.
    sex = F.when(F.col("_sex").isNotNull(), F.coalesce("_standard_sex", F.lit("UNMAPPED")))
    found = found.withColumns({"sex": sex, "baseline_condition": F.col("_dx_description")})
    return validate(found, subject_rules()).select(
        *SUBJECT_COLUMNS, "source_snapshot_date", *LINEAGE, *ROUTING
    )


SUBJECT_HISTORY = dict(
    sequence=["source_snapshot_date", "_source_file_name"],
    track_except=list(s.LINEAGE_UNTRACKED),
)


def subject_history(valid: DataFrame, **options) -> DataFrame:
    """Type 2 history by delivery date and file; lineage changes open no version.

    Pass a written table. A key has at most one row per delivered file.
    """
    return scd2(valid, ["subject_id"], **SUBJECT_HISTORY, **options)


# --- visits --------------------------------------------------------------------

def visit_rules() -> list[r.Rule]:
    """The 12 blocking rules, in reporting order."""
    return [
        r.missing("missing_visit_id", "visit_id"),
        r.missing("missing_subject_id", "subject_id"),
        r.unknown("unknown_silver_subject", "subject_id", "_subject_key"),
        r.missing("missing_study_id", "study_id"),
        r.unknown("unknown_study_id", "study_id", "_study_key"),
        r.missing("missing_site_id", "site_id"),
        r.unknown("unknown_site_id", "site_id", "_site_key"),
        r.mismatch("site_not_in_study", "study_id", "_site_study"),
        r.mismatch("subject_not_in_study", "study_id", "_subject_study"),
        r.mismatch("subject_not_in_site", "site_id", "_subject_site"),
        r.not_in("invalid_visit_status", "visit_status", s.VISIT_STATUSES, null_fails=False),
        r.required_when("completed_visit_missing_date", F.col("visit_status") == "COMPLETED",
                        "visit_date"),
    ]


def validate_visits(raw: DataFrame, t: Tables, history: DataFrame) -> DataFrame:
    """Typed, resolved and rule-checked visits."""
    clean = raw.withColumns({
        **{c: normalize_key(c) for c in ("visit_id", "subject_id", "study_id", "site_id", "visit_name")},
        "visit_status": map_values("visit_status", s.VISIT_STATUS_WORDS, null_as="UNKNOWN"),
    })
    clean = typed(clean, {"visit_number": "int", "days_from_baseline": "int", "visit_date": "date"})
    found = lookup(clean, study_keys(t), {"study_id": "_study_key"})
    found = lookup(found, site_ref(t), {"site_id": "_site_key"})
    found = lookup(found, trusted_subjects(history), {"subject_id": "_subject_key"}, split_nulls=True)
    return validate(found, visit_rules()).select(
        *s.FEEDS["visits"].columns, RESCUED, *LINEAGE, *ROUTING, *_identity(raw)
    )


# --- adverse events ------------------------------------------------------------

def adverse_event_rules() -> list[r.Rule]:
    """The 10 blocking rules, in reporting order."""
    return [
        r.missing("missing_ae_id", "ae_id"),
        r.missing("missing_subject_id", "subject_id"),
        r.unknown("unknown_silver_subject", "subject_id", "_subject_key"),
        r.mismatch("subject_study_mismatch", "study_id", "_subject_study"),
        r.mismatch("subject_site_mismatch", "site_id", "_subject_site"),
        r.missing("missing_study_id", "study_id"),
        r.missing("missing_site_id", "site_id"),
        r.unknown("unknown_site_id", "site_id", "_site_key"),
        r.mismatch("site_study_mismatch", "study_id", "_site_study"),
        r.unparseable("invalid_onset_date", "_raw_onset", "onset_date"),
    ]


def adverse_event_warnings() -> dict[str, Column]:
    """The 5 warnings; a row with one stays valid."""
    rank, serious = F.col("severity_rank"), F.col("serious_flag")
    onset, resolved = F.col("onset_date"), F.col("resolution_date")
    return {
        "severity_mapping_warning":
            F.col("source_severity").isNotNull() & F.col("standard_severity").isNull(),
        # Both dates known, so never NULL.
        "resolution_before_onset_warning": F.coalesce(resolved < onset, F.lit(False)),
        "high_severity_nonserious_warning": rank.isin(3, 4, 5) & (serious == "NO"),
        "mild_serious_warning": (rank == 1) & (serious == "YES"),
        "fatal_nonserious_warning": (F.col("outcome") == "FATAL") & (serious == "NO"),
    }


ADVERSE_EVENT_COLUMNS = [
    "ae_id", "subject_id", "study_id", "site_id", "ae_term", "meddra_soc", "source_severity",
    "standard_severity", "severity_rank", "source_serious_flag", "serious_flag", "onset_date",
    "resolution_date", "outcome", "related_to_study_drug", "action_taken",
]


def validate_adverse_events(raw: DataFrame, t: Tables, history: DataFrame) -> DataFrame:
    """Typed, resolved, flagged and rule-checked adverse events."""
    clean = raw.withColumns({
        **{c: normalize_key(c) for c in (
            "ae_id", "subject_id", "study_id", "site_id", "outcome", "related_to_study_drug",
            "action_taken")},
        **{c: blank_to_null(c) for c in ("ae_term", "meddra_soc")},
        "source_severity": blank_to_null("severity"),
        "_severity": normalize_category("severity"),
        "source_serious_flag": normalize_category("serious_flag"),
        "serious_flag": map_flag("serious_flag"),
        "_raw_onset": blank_to_null("onset_date"),
        "onset_date": parse_date("onset_date", "yyyy-MM-dd"),
        "resolution_date": parse_date("resolution_date", "yyyy-MM-dd"),
    })
    found = lookup(clean, severity_ref(t), {"_severity": "_severity_key"})
    found = lookup(found, site_ref(t), {"site_id": "_site_key"})
    found = lookup(found, trusted_subjects(history), {"subject_id": "_subject_key"}, split_nulls=True)
    found = found.withColumns({"standard_severity": F.col("_standard_severity"),
                               "severity_rank": F.col("_severity_rank")})
    warnings = adverse_event_warnings()
    return validate(warn(found, warnings), adverse_event_rules()).select(
        *ADVERSE_EVENT_COLUMNS, *warnings, RESCUED, *LINEAGE, *ROUTING, *_identity(raw)
    )


# --- lab results ---------------------------------------------------------------

def lab_rules() -> list[r.Rule]:
    """The 16 blocking rules, in reporting order."""
    measured = F.col("result_value").isNotNull() & F.col("result_unit").isNotNull()
    return [
        r.missing("missing_lab_result_id", "lab_result_id"),
        r.missing("missing_subject_id", "subject_id"),
        r.unknown("unknown_silver_subject", "subject_id", "_subject_key"),
        r.mismatch("subject_study_mismatch", "study_id", "_subject_study"),
        r.missing("missing_study_id", "study_id"),
        r.missing("missing_visit_id", "visit_id"),
        r.unknown("unknown_silver_visit", "visit_id", "_visit_key"),
        r.mismatch("visit_subject_mismatch", "subject_id", "_visit_subject"),
        r.mismatch("visit_study_mismatch", "study_id", "_visit_study"),
        r.missing("missing_lab_test_code", "lab_test_code"),
        r.unknown("unknown_lab_test_code", "lab_test_code", "_test_key"),
        r.missing("missing_result_value", "result_value"),
        r.missing("missing_result_unit", "result_unit"),
        r.required_when("unmapped_test_unit", measured, "_factor"),
        r.bad_range("invalid_standard_reference_range", "_test_key", "_test_low", "_test_high"),
        r.missing("invalid_collection_date", "collection_date"),
    ]


LAB_COLUMNS = [
    "lab_result_id", "subject_id", "study_id", "visit_id", "lab_test_code", "lab_test_name",
    "result_value", "result_unit", "standardized_result_value", "standard_unit",
    "conversion_factor", "source_reference_low", "source_reference_high",
    "standard_reference_low", "standard_reference_high", "source_abnormal_flag",
    "derived_abnormal_flag", "derived_direction", "abnormal_flag_discrepancy",
    "collection_date", "lab_vendor",
]


def validate_labs(raw: DataFrame, t: Tables, history: DataFrame, visits: DataFrame) -> DataFrame:
    """Typed, resolved, standardised and rule-checked laboratory results."""
    clean = raw.withColumns({
        **{c: normalize_key(c) for c in (
            "lab_result_id", "subject_id", "study_id", "visit_id", "lab_test_code", "lab_vendor")},
        **{c: blank_to_null(c) for c in ("lab_test_name", "result_unit")},
        "_unit": normalize_category("result_unit"),
        "result_value": F.col("result_value").try_cast("double"),
        "source_reference_low": F.col("reference_low").try_cast("double"),
        "source_reference_high": F.col("reference_high").try_cast("double"),
        "source_abnormal_flag": normalize_category("abnormal_flag"),
        "collection_date": parse_date("collection_date", s.LAB_DATE_FORMAT),
    })
    found = lookup(clean, lab_test_ref(t), {"lab_test_code": "_test_key"})
    found = lookup(found, unit_ref(t), {"lab_test_code": "_unit_test", "_unit": "_unit_key"})
    found = lookup(found, trusted_subjects(history), {"subject_id": "_subject_key"}, split_nulls=True)
    found = lookup(found, trusted_visits(visits), {"visit_id": "_visit_key"}, split_nulls=True)
    found = standardise(found, "result_value", "_factor", "_unit_standard", "_test_unit",
                        "_test_low", "_test_high", "source_abnormal_flag")
    return validate(found, lab_rules()).select(*LAB_COLUMNS, RESCUED, *LINEAGE, *ROUTING, *_identity(raw))
