"""Metric tables over the trusted clinical tables.

All take ``as_of`` (a DATE column, normally a literal) instead of the clock,
so a rerun gives the same numbers. Every fact is scanned once per metric table.
Subjects are counted distinct on the map side first, so a subject or site with
very many rows does not land whole in one task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from dqlake.functions import (
    band, elapsed_days, ever, hi, lo, median, n, n_distinct, n_distinct_if, n_if, rate, stamp,
    total,
)
from dqlake.operators import (
    END, START, Layers, calendar, combine_rollups, inherit, reconcile, rollup, running_sum, stack,
    zero_fill,
)
from dqlake.operators.rules import FAILURES

from . import schemas as s

GENERATED = "_gold_generated_at"
SITE = ["study_id", "site_id"]

CURRENT_COLUMNS = [
    "study_id", "site_id", "arm_code", "age", "sex", "baseline_condition_code",
    "baseline_condition", "informed_consent_date", "screening_date", "enrollment_date",
    "randomization_date", "discontinuation_date", "discontinuation_reason",
]


def _rates(df: DataFrame, rates: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add ratios; numerator and denominator stay, so they can be summed again."""
    return df.withColumns({name: rate(num, den) for name, (num, den) in rates.items()})


def _direction(*words: str) -> Column:
    return F.col("derived_direction").isin(*words)


def _sites(history: DataFrame) -> DataFrame:
    """Site of each trusted subject."""
    return history.where(F.col(END).isNull()).select("subject_id", "site_id")


def subject_spine(history: DataFrame, as_of: Column) -> DataFrame:
    """One row per subject: open version, what ever happened, version dates."""
    status = F.upper("subject_status")
    delivered = F.col(f"{START}.source_snapshot_date")
    dated = {"screened": "screening_date", "enrolled": "enrollment_date",
             "randomized": "randomization_date"}
    # The open version is the one that starts last.
    latest = F.max_by(F.struct(*CURRENT_COLUMNS, F.col("subject_status").alias("current_subject_status")),
                      F.col(START))
    per_subject = rollup(history, ["subject_id"], {
        "__now": latest,
        **{f"ever_{k}_flag": ever(F.col(c).isNotNull()) for k, c in dated.items()},
        "ever_completed_flag": ever(status.isin(*s.COMPLETED_WORDS)),
        "ever_discontinued_flag": ever(
            F.col("discontinuation_date").isNotNull() | status.isin(*s.DISCONTINUED_WORDS)),
        "ever_screen_failed_flag": ever(status.isin(*s.SCREEN_FAILED_WORDS)),
        "subject_version_count": n(),
        "first_version_at": lo(delivered),
        "last_version_at": hi(delivered),
    })
    flat = per_subject.select("subject_id", "__now.*", *per_subject.columns[2:])
    spine = flat.withColumns({
        "age_group": band("age", [65]),
        "days_on_study": elapsed_days("screening_date", "discontinuation_date", as_of),
    })
    return stamp(spine, GENERATED, as_of)


def subject_summary(
    spine: DataFrame, visits: DataFrame, adverse_events: DataFrame, labs: DataFrame, as_of: Column
) -> DataFrame:
    """Spine with each subject's visit, event and lab rollup."""
    status = F.col("visit_status")
    visit = rollup(visits, ["subject_id"], {
        "total_visits": n(),
        **{f"{w.lower()}_visits": n_if(status == w) for w in s.VISIT_STATUSES},
        "first_visit_date": lo("visit_date"), "last_visit_date": hi("visit_date"),
    })
    event = rollup(adverse_events, ["subject_id"], {
        "ae_count": n(),
        "serious_ae_count": n_if(F.col("serious_flag") == "YES"),
        "fatal_ae_count": n_if(F.col("outcome") == "FATAL"),
        "ongoing_ae_count": n_if(F.col("resolution_date").isNull()),
        "max_ae_severity": hi("severity_rank"),
    })
    lab = rollup(labs, ["subject_id"], {
        "total_lab_results": n(),
        "abnormal_lab_count": n_if(_direction("LOW", "HIGH")),
        "lab_flag_discrepancy_count": n_if(F.col("abnormal_flag_discrepancy")),
    })
    out = combine_rollups(
        spine.drop(GENERATED),
        _rates(visit, {"visit_completion_rate": ("completed_visits", "total_visits")}),
        event,
        _rates(lab, {"abnormal_lab_rate": ("abnormal_lab_count", "total_lab_results")}),
        on=["subject_id"],
    )
    out = out.withColumn("days_since_last_visit", elapsed_days("last_visit_date", None, as_of))
    return stamp(out, GENERATED, as_of)


def subject_disposition(spine: DataFrame, as_of: Column) -> DataFrame:
    """Funnel per study and site."""
    flags = ("screened", "screen_failed", "enrolled", "randomized", "completed", "discontinued")
    going = ((F.col("ever_enrolled_flag") == 1) & (F.col("ever_completed_flag") == 0)
             & (F.col("ever_discontinued_flag") == 0))
    out = rollup(spine, SITE, {
        **{f"{f}_subjects": total(f"ever_{f}_flag") for f in flags},
        "ongoing_subjects": n_if(going),
    })
    out = _rates(out, {
        "screen_failure_rate": ("screen_failed_subjects", "screened_subjects"),
        "randomization_rate": ("randomized_subjects", "enrolled_subjects"),
        "completion_rate": ("completed_subjects", "enrolled_subjects"),
        "discontinuation_rate": ("discontinued_subjects", "enrolled_subjects"),
    })
    return stamp(out, GENERATED, as_of)


def discontinuation_reasons(spine: DataFrame, as_of: Column) -> DataFrame:
    """Discontinued subjects per study, site and reason."""
    out = spine.where("ever_discontinued_flag = 1").withColumn(
        "discontinuation_reason", F.coalesce("discontinuation_reason", F.lit("UNKNOWN")))
    out = rollup(out, [*SITE, "discontinuation_reason"],
                 {"discontinued_subjects": n_distinct("subject_id")})
    return stamp(out, GENERATED, as_of)


def enrollment_timeseries(spine: DataFrame, as_of: Column) -> DataFrame:
    """Dense monthly counts per study and site with running sums.

    The spine has one row per subject, so each subject's dates become
    (month, event) rows that are counted in a single aggregate.
    """
    events = {"screened": "screening_date", "enrolled": "enrollment_date",
              "randomized": "randomization_date", "discontinued": "discontinuation_date"}
    starts = [F.col(c) for c in ("screening_date", "enrollment_date", "randomization_date")]
    bounds = rollup(spine, SITE, {
        "__first": F.trunc(lo(F.least(*starts)), "month"),
        "__last": F.trunc(F.greatest(*[hi(c) for c in events.values()], as_of), "month"),
    }).where("__first is not null")
    months = calendar(bounds, "__first", "__last", "month_start")
    dated = F.array(*[F.struct(F.lit(e).alias("event"), F.trunc(c, "month").alias("month_start"))
                      for e, c in events.items()])
    monthly = (
        spine.select(*SITE, F.explode(dated).alias("e")).select(*SITE, "e.*")
        .where("month_start is not null")
    )
    monthly = rollup(monthly, [*SITE, "month_start"],
                     {f"{e}_subjects": n_if(F.col("event") == e) for e in events})
    out = zero_fill(combine_rollups(months, monthly, on=[*SITE, "month_start"]),
                    [f"{e}_subjects" for e in events])
    out = running_sum(out, SITE, "month_start", {
        f"cum_{e}_subjects": f"{e}_subjects" for e in ("screened", "enrolled", "randomized")})
    return stamp(out, GENERATED, as_of)


def site_performance(
    spine: DataFrame, visits: DataFrame, adverse_events: DataFrame, labs: DataFrame,
    history: DataFrame, as_of: Column,
) -> DataFrame:
    """Enrolment, visit, safety and lab burden per study and site."""
    subject = rollup(spine, SITE, {
        "first_screening_date": lo("screening_date"),
        "first_enrollment_date": lo("enrollment_date"),
        "last_enrollment_date": hi("enrollment_date"),
        **{f"subjects_{f}": total(f"ever_{f}_flag")
           for f in ("screened", "enrolled", "randomized", "completed", "discontinued")},
    })
    months = F.months_between(as_of, "first_screening_date")
    subject = subject.withColumn(
        "active_months",
        F.when(F.col("first_screening_date").isNotNull(), F.greatest(F.lit(1.0), months)))
    visit = rollup(visits, SITE, {
        "scheduled_visits": n(),
        "completed_visits": n_if(F.col("visit_status") == "COMPLETED"),
        "missed_visits": n_if(F.col("visit_status") == "MISSED"),
    })
    per_subject = rollup(adverse_events, [*SITE, "subject_id"],
                         {"__events": n(), "__serious": ever(F.col("serious_flag") == "YES")})
    event = rollup(per_subject, SITE, {
        "ae_events": total("__events"), "subjects_with_ae": F.count("subject_id"),
        "subjects_with_serious_ae": total("__serious"),
    })
    lab = rollup(labs, ["study_id", "subject_id"],
                 {"__all": n(), "__abnormal": n_if(_direction("LOW", "HIGH"))})
    lab = rollup(inherit(lab, _sites(history), "subject_id", ["site_id"]), SITE,
                 {"lab_results": total("__all"), "abnormal_lab_results": total("__abnormal")})
    out = combine_rollups(subject, visit, event, lab, on=SITE).withColumn(
        "screen_failure_count", F.col("subjects_screened") - F.col("subjects_enrolled"))
    out = _rates(out, {
        "screen_failure_rate": ("screen_failure_count", "subjects_screened"),
        "discontinuation_rate": ("subjects_discontinued", "subjects_enrolled"),
        "enrollment_rate_per_month": ("subjects_enrolled", "active_months"),
        "visit_completion_rate": ("completed_visits", "scheduled_visits"),
        "ae_events_per_subject": ("ae_events", "subjects_enrolled"),
        "abnormal_lab_rate": ("abnormal_lab_results", "lab_results"),
    })
    return stamp(out, GENERATED, as_of)


def visit_compliance(visits: DataFrame, as_of: Column) -> DataFrame:
    """Attendance per study, site and protocol visit; unknown statuses are not eligible."""
    by = [*SITE, "visit_name", "visit_number"]
    status = F.col("visit_status")
    counts = {"eligible_visits": n_if(status.isin(*s.VISIT_STATUSES)),
              **{f"{w.lower()}_visits": n_if(status == w) for w in s.VISIT_STATUSES},
              "unknown_status_visits": n_if(~status.isin(*s.VISIT_STATUSES))}
    out = rollup(visits, by, {"subjects_with_visit": n_distinct("subject_id"), **counts,
                              "median_days_from_baseline": median("days_from_baseline")})
    out = _rates(out, {
        "visit_completion_rate": ("completed_visits", "eligible_visits"),
        "missed_visit_rate": ("missed_visits", "eligible_visits"),
    })
    return stamp(out, GENERATED, as_of)


def safety_metrics(adverse_events: DataFrame, spine: DataFrame, as_of: Column) -> DataFrame:
    """Adverse events per study, site, organ class, severity and seriousness."""
    population = rollup(spine, SITE, {"subjects_at_risk": n_distinct("subject_id")})
    resolved = F.col("resolution_date").isNotNull()
    events = rollup(
        adverse_events.withColumn("ae_severity", F.col("standard_severity")),
        [*SITE, "meddra_soc", "ae_severity", "serious_flag"],
        {"ae_events": n(), "subjects_with_ae": n_distinct("subject_id"),
         "fatal_events": n_if(F.col("outcome") == "FATAL"),
         "ongoing_events": n_if(~resolved), "resolved_events": n_if(resolved)},
    )
    out = combine_rollups(events, population, on=SITE)
    out = out.withColumn("ae_incidence_pct", rate("subjects_with_ae", "subjects_at_risk") * 100)
    return stamp(out, GENERATED, as_of)


def lab_monitoring(labs: DataFrame, history: DataFrame, as_of: Column) -> DataFrame:
    """Lab results per study, site, test and unit; the site comes through the subject."""
    by = [*SITE, "lab_test_code", "lab_test_name", "standard_unit"]
    abnormal, value = _direction("LOW", "HIGH"), "standardized_result_value"
    slim = labs.select("study_id", "subject_id", *by[2:], "derived_direction", "abnormal_flag_discrepancy", value)
    # one scan, one join, one aggregate: the distinct counts are formed per subject on the map side
    out = rollup(inherit(slim, _sites(history), "subject_id", ["site_id"]), by, {
        "subjects_tested": n_distinct("subject_id"), "total_results": n(),
        "normal_count": n_if(_direction("NORMAL")), "low_count": n_if(_direction("LOW")),
        "high_count": n_if(_direction("HIGH")), "abnormal_count": n_if(abnormal),
        "subjects_with_abnormal": n_distinct_if(abnormal, "subject_id"),
        "source_derived_discrepancy_count": n_if(F.col("abnormal_flag_discrepancy")),
        "min_standardized_value": lo(value), "max_standardized_value": hi(value),
        "median_standardized_value": median(value),
    })
    out = _rates(out, {
        "abnormal_rate": ("abnormal_count", "total_results"),
        "discrepancy_rate": ("source_derived_discrepancy_count", "total_results"),
    })
    return stamp(out, GENERATED, as_of)


# Record key of each entity.
RECORD_KEYS = {"subjects": "subject_id", "visits": "visit_id", "lab_results": "lab_result_id",
               "adverse_events": "ae_id"}


def data_quality_metrics(
    rejected: Mapping[str, DataFrame], history: DataFrame, as_of: Column
) -> DataFrame:
    """Failures per entity, study, site and rule. A row may break several rules,
    so counts do not add up across rules."""
    parts = []
    for entity, df in rejected.items():
        if "site_id" not in df.columns:
            slim = df.select("subject_id", "study_id", RECORD_KEYS[entity], FAILURES)
            # Rejected rows often lack the subject.
            df = inherit(slim, _sites(history), "subject_id", ["site_id"], split_nulls=True)
        parts.append(df.select(
            F.lit(entity).alias("source_entity"),
            *[F.coalesce(c, F.lit("UNKNOWN")).alias(c) for c in SITE],
            F.col(RECORD_KEYS[entity]).cast("string").alias("__record"),
            F.explode(FAILURES).alias("dq_rule"),
        ))
    out = rollup(stack(*parts), ["source_entity", *SITE, "dq_rule"],
                 {"failure_count": n(), "affected_records": n_distinct("__record")})
    return stamp(out, GENERATED, as_of)


def reconciliation(entities: Mapping[str, Layers], as_of: Column) -> DataFrame:
    """Layer balance per entity."""
    return stamp(reconcile(entities), GENERATED, as_of)
