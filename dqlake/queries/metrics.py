"""Queries over the metric tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dqlake.operators import Layers, conservation
from dqlake.plans import gold, silver

from .oracle import DAY, big, ratio, with_tables
from .registry import query
from .silver_store import as_of, store

# Feed names of the store and entity names of the reports.
ENTITIES = {"subjects": "subjects", "visits": "visits", "labs": "lab_results",
            "adverse_events": "adverse_events"}


def _plain(df: DataFrame) -> DataFrame:
    return df.drop(gold.GENERATED)


@query(with_tables("SELECT * FROM spine", "spine"))
def subject_spine(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(gold.subject_spine(store(spark, sf).history(), as_of()))


_VISIT_ROLLUP = f"""
    SELECT subject_id, count(*) AS total_visits,
      count(*) FILTER (WHERE visit_status = 'COMPLETED') AS completed_visits,
      count(*) FILTER (WHERE visit_status = 'MISSED') AS missed_visits,
      count(*) FILTER (WHERE visit_status = 'RESCHEDULED') AS rescheduled_visits,
      min(visit_date) AS first_visit_date, max(visit_date) AS last_visit_date,
      (count(*) FILTER (WHERE visit_status = 'COMPLETED')) / count(*) AS visit_completion_rate
    FROM visits_ok GROUP BY 1"""
_EVENT_ROLLUP = """
    SELECT subject_id, count(*) AS ae_count,
      count(*) FILTER (WHERE serious_flag = 'YES') AS serious_ae_count,
      count(*) FILTER (WHERE outcome = 'FATAL') AS fatal_ae_count,
      count(*) FILTER (WHERE resolution_date IS NULL) AS ongoing_ae_count,
      max(severity_rank) AS max_ae_severity FROM events_ok GROUP BY 1"""
_LAB_ROLLUP = """
    SELECT subject_id, count(*) AS total_lab_results,
      count(*) FILTER (WHERE derived_direction IN ('LOW', 'HIGH')) AS abnormal_lab_count,
      count(*) FILTER (WHERE discrepancy) AS lab_flag_discrepancy_count,
      (count(*) FILTER (WHERE derived_direction IN ('LOW', 'HIGH'))) / count(*) AS abnormal_lab_rate
    FROM labs_ok GROUP BY 1"""


@query(with_tables(f"""
    SELECT s.*, v.* EXCLUDE (subject_id), e.* EXCLUDE (subject_id), l.* EXCLUDE (subject_id),
      CAST(date_diff('day', last_visit_date, {DAY}) AS INT) AS days_since_last_visit
    FROM spine s LEFT JOIN ({_VISIT_ROLLUP}) v ON s.subject_id = v.subject_id
    LEFT JOIN ({_EVENT_ROLLUP}) e ON s.subject_id = e.subject_id
    LEFT JOIN ({_LAB_ROLLUP}) l ON s.subject_id = l.subject_id""",
    "spine", "visits_ok", "events_ok", "labs_ok"))
def subject_summary(spark: SparkSession, sf: str) -> DataFrame:
    st = store(spark, sf)
    return _plain(gold.subject_summary(st.spine(), st.valid("visits"), st.valid("adverse_events"),
                                       st.valid("labs"), as_of()))


_FUNNEL = ", ".join(f"{big(f'sum(ever_{f}_flag)')} AS {f}_subjects" for f in (
    "screened", "screen_failed", "enrolled", "randomized", "completed", "discontinued"))


@query(with_tables(f"""
    SELECT *, {ratio('screen_failed_subjects', 'screened_subjects')} AS screen_failure_rate,
      {ratio('randomized_subjects', 'enrolled_subjects')} AS randomization_rate,
      {ratio('completed_subjects', 'enrolled_subjects')} AS completion_rate,
      {ratio('discontinued_subjects', 'enrolled_subjects')} AS discontinuation_rate
    FROM (SELECT study_id, site_id, {_FUNNEL},
            count(*) FILTER (WHERE ever_enrolled_flag = 1 AND ever_completed_flag = 0
                             AND ever_discontinued_flag = 0) AS ongoing_subjects
          FROM spine GROUP BY 1, 2)""", "spine"))
def subject_disposition(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(gold.subject_disposition(store(spark, sf).spine(), as_of()))


@query(with_tables("""
    SELECT study_id, site_id, coalesce(discontinuation_reason, 'UNKNOWN') AS discontinuation_reason,
      count(DISTINCT subject_id) AS discontinued_subjects
    FROM spine WHERE ever_discontinued_flag = 1 GROUP BY 1, 2, 3""", "spine"))
def discontinuation_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(gold.discontinuation_reasons(store(spark, sf).spine(), as_of()))


def _monthly(event: str, column: str) -> str:
    return (f"LEFT JOIN (SELECT study_id, site_id, date_trunc('month', {column})::DATE AS month_start, "
            f"count(DISTINCT subject_id) AS k FROM spine WHERE {column} IS NOT NULL GROUP BY 1, 2, 3) {event} "
            "USING (study_id, site_id, month_start)")


_EVENT_DATES = {"screened": "screening_date", "enrolled": "enrollment_date",
                "randomized": "randomization_date", "discontinued": "discontinuation_date"}
_RUNNING = ", ".join(f"CAST(sum({e}_subjects) OVER w AS BIGINT) AS cum_{e}_subjects"
                     for e in ("screened", "enrolled", "randomized"))


@query(with_tables(f"""
    SELECT *, {_RUNNING} FROM (
      SELECT study_id, site_id, month_start,
        {', '.join(f'coalesce({e}.k, 0) AS {e}_subjects' for e in _EVENT_DATES)}
      FROM (SELECT study_id, site_id, unnest(generate_series(first_month, last_month,
                   INTERVAL 1 MONTH))::DATE AS month_start
            FROM (SELECT study_id, site_id,
                    date_trunc('month', min(least(screening_date, enrollment_date, randomization_date)))
                      AS first_month,
                    date_trunc('month', greatest(max(screening_date), max(enrollment_date),
                      max(randomization_date), max(discontinuation_date), {DAY})) AS last_month
                  FROM spine GROUP BY 1, 2) WHERE first_month IS NOT NULL)
      {' '.join(_monthly(e, c) for e, c in _EVENT_DATES.items())})
    WINDOW w AS (PARTITION BY study_id, site_id ORDER BY month_start)""", "spine"))
def enrollment_timeseries(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(gold.enrollment_timeseries(store(spark, sf).spine(), as_of()))


_FIRST = "first_screening_date"
_WHOLE = f"((year({DAY}) - year({_FIRST})) * 12 + month({DAY}) - month({_FIRST}))"
# Months between two dates: whole between equal days or two month ends, else 31sts.
_MONTHS = f"""
    CASE WHEN day({DAY}) = day({_FIRST}) OR ({DAY} = last_day({DAY}) AND {_FIRST} = last_day({_FIRST}))
      THEN CAST({_WHOLE} AS DOUBLE)
      ELSE round({_WHOLE} + (day({DAY}) - day({_FIRST})) / CAST(31 AS DOUBLE), 8) END"""


@query(with_tables(f"""
    SELECT * EXCLUDE (months), round(months, 6) AS active_months,
      subjects_screened - subjects_enrolled AS screen_failure_count,
      {ratio('(subjects_screened - subjects_enrolled)', 'subjects_screened')} AS screen_failure_rate,
      {ratio('subjects_discontinued', 'subjects_enrolled')} AS discontinuation_rate,
      round(CASE WHEN months > 0 THEN subjects_enrolled / months END, 6) AS enrollment_rate_per_month,
      {ratio('completed_visits', 'scheduled_visits')} AS visit_completion_rate,
      {ratio('ae_events', 'subjects_enrolled')} AS ae_events_per_subject,
      {ratio('abnormal_lab_results', 'lab_results')} AS abnormal_lab_rate
    FROM (SELECT *, CASE WHEN first_screening_date IS NOT NULL THEN greatest(1.0, {_MONTHS}) END AS months
      FROM (SELECT study_id, site_id, min(screening_date) AS first_screening_date,
              min(enrollment_date) AS first_enrollment_date, max(enrollment_date) AS last_enrollment_date,
              {', '.join(f"{big(f'sum(ever_{f}_flag)')} AS subjects_{f}" for f in (
                  'screened', 'enrolled', 'randomized', 'completed', 'discontinued'))}
            FROM spine GROUP BY 1, 2)
      LEFT JOIN (SELECT study_id, site_id, count(*) AS scheduled_visits,
                   count(*) FILTER (WHERE visit_status = 'COMPLETED') AS completed_visits,
                   count(*) FILTER (WHERE visit_status = 'MISSED') AS missed_visits
                 FROM visits_ok GROUP BY 1, 2) USING (study_id, site_id)
      LEFT JOIN (SELECT study_id, site_id, count(*) AS ae_events,
                   count(DISTINCT subject_id) AS subjects_with_ae,
                   count(DISTINCT CASE WHEN serious_flag = 'YES' THEN subject_id END)
                     AS subjects_with_serious_ae
                 FROM events_ok GROUP BY 1, 2) USING (study_id, site_id)
      LEFT JOIN (SELECT l.study_id, n.site_id, count(*) AS lab_results,
                   count(*) FILTER (WHERE derived_direction IN ('LOW', 'HIGH')) AS abnormal_lab_results
                 FROM labs_ok l LEFT JOIN now n ON l.subject_id = n.subject_id GROUP BY 1, 2)
        USING (study_id, site_id))""", "spine", "visits_ok", "events_ok", "labs_ok", "now"))
def site_performance(spark: SparkSession, sf: str) -> DataFrame:
    st = store(spark, sf)
    out = gold.site_performance(st.spine(), st.valid("visits"), st.valid("adverse_events"),
                                st.valid("labs"), st.history(), as_of())
    rounded = ("active_months", "enrollment_rate_per_month")
    return _plain(out.withColumns({c: F.round(c, 6) for c in rounded}))


@query(with_tables(f"""
    SELECT *, {ratio('completed_visits', 'eligible_visits')} AS visit_completion_rate,
      {ratio('missed_visits', 'eligible_visits')} AS missed_visit_rate
    FROM (SELECT study_id, site_id, visit_name, visit_number,
            count(DISTINCT subject_id) AS subjects_with_visit,
            count(*) FILTER (WHERE visit_status IN ('COMPLETED', 'MISSED', 'RESCHEDULED')) AS eligible_visits,
            count(*) FILTER (WHERE visit_status = 'COMPLETED') AS completed_visits,
            count(*) FILTER (WHERE visit_status = 'MISSED') AS missed_visits,
            count(*) FILTER (WHERE visit_status = 'RESCHEDULED') AS rescheduled_visits,
            count(*) FILTER (WHERE visit_status NOT IN ('COMPLETED', 'MISSED', 'RESCHEDULED'))
              AS unknown_status_visits,
            quantile_disc(days_from_baseline, 0.5) AS median_days_from_baseline
          FROM visits_ok GROUP BY 1, 2, 3, 4)""", "visits_ok"))
def visit_compliance(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(gold.visit_compliance(store(spark, sf).valid("visits"), as_of()))


@query(with_tables(f"""
    SELECT e.*, subjects_at_risk,
      {ratio('subjects_with_ae', 'subjects_at_risk')} * 100 AS ae_incidence_pct
    FROM (SELECT study_id, site_id, meddra_soc, standard_severity AS ae_severity, serious_flag,
            count(*) AS ae_events, count(DISTINCT subject_id) AS subjects_with_ae,
            count(*) FILTER (WHERE outcome = 'FATAL') AS fatal_events,
            count(*) FILTER (WHERE resolution_date IS NULL) AS ongoing_events,
            count(*) FILTER (WHERE resolution_date IS NOT NULL) AS resolved_events
          FROM events_ok GROUP BY 1, 2, 3, 4, 5) e
    LEFT JOIN (SELECT study_id, site_id, count(DISTINCT subject_id) AS subjects_at_risk
               FROM spine GROUP BY 1, 2) USING (study_id, site_id)""", "events_ok", "spine"))
def safety_metrics(spark: SparkSession, sf: str) -> DataFrame:
    st = store(spark, sf)
    return _plain(gold.safety_metrics(st.valid("adverse_events"), st.spine(), as_of()))


@query(with_tables(f"""
    SELECT *, {ratio('abnormal_count', 'total_results')} AS abnormal_rate,
      {ratio('source_derived_discrepancy_count', 'total_results')} AS discrepancy_rate
    FROM (SELECT l.study_id, n.site_id, lab_test_code, lab_test_name, standard_unit,
            count(*) AS total_results, count(DISTINCT l.subject_id) AS subjects_tested,
            count(*) FILTER (WHERE derived_direction = 'NORMAL') AS normal_count,
            count(*) FILTER (WHERE derived_direction = 'LOW') AS low_count,
            count(*) FILTER (WHERE derived_direction = 'HIGH') AS high_count,
            count(*) FILTER (WHERE derived_direction IN ('LOW', 'HIGH')) AS abnormal_count,
            count(DISTINCT CASE WHEN derived_direction IN ('LOW', 'HIGH') THEN l.subject_id END)
              AS subjects_with_abnormal,
            count(*) FILTER (WHERE discrepancy) AS source_derived_discrepancy_count,
            min(sv) AS min_standardized_value, quantile_disc(sv, 0.5) AS median_standardized_value,
            max(sv) AS max_standardized_value
          FROM labs_ok l LEFT JOIN now n ON l.subject_id = n.subject_id GROUP BY 1, 2, 3, 4, 5)""",
    "labs_ok", "now"))
def lab_monitoring(spark: SparkSession, sf: str) -> DataFrame:
    st = store(spark, sf)
    return _plain(gold.lab_monitoring(st.valid("labs"), st.history(), as_of()))


def _failures(entity: str, table: str, key: str, site: str = "site_id") -> str:
    join = "LEFT JOIN now n ON t.subject_id = n.subject_id" if site != "site_id" else ""
    return (f"SELECT '{entity}' AS source_entity, coalesce(t.study_id, 'UNKNOWN') AS study_id, "
            f"coalesce({site}, 'UNKNOWN') AS site_id, {key} AS rec, unnest(string_split(why, ';')) AS dq_rule "
            f"FROM {table} t {join} WHERE why <> ''")


@query(with_tables(f"""
    SELECT source_entity, study_id, site_id, dq_rule, count(*) AS failure_count,
      count(DISTINCT rec) AS affected_records
    FROM ({_failures('subjects', 'subjects_v', 't.subject_id')}
          UNION ALL {_failures('visits', 'visits_v', 'visit_id')}
          UNION ALL {_failures('lab_results', 'labs_v', 'lab_result_id', 'n.site_id')}
          UNION ALL {_failures('adverse_events', 'events_v', 'ae_id')}) GROUP BY 1, 2, 3, 4""",
    "subjects_v", "visits_v", "labs_v", "events_v", "now"))
def data_quality_metrics(spark: SparkSession, sf: str) -> DataFrame:
    st = store(spark, sf)
    rejected = {entity: st.rejected(feed) for feed, entity in ENTITIES.items()}
    return _plain(gold.data_quality_metrics(rejected, st.history(), as_of()))


def _balance(entity: str, raw: str, checked: str, silver: str) -> str:
    extra = ("(SELECT count(*) FROM now) AS current_records, (SELECT count(DISTINCT subject_id) FROM hist) AS distinct_keys"
             if entity == "subjects" else "CAST(NULL AS BIGINT) AS current_records, CAST(NULL AS BIGINT) AS distinct_keys")
    return (f"SELECT '{entity}' AS source_entity, (SELECT count(*) FROM {raw}) AS bronze_records, "
            f"(SELECT count(*) FROM {silver}) AS silver_records, "
            f"(SELECT count(*) FROM {checked} WHERE why <> '') AS quarantined_records, "
            f"(SELECT count(*) FROM {checked} WHERE why = '') - (SELECT count(*) FROM {silver}) "
            f"AS collapsed_records, {extra}")


@query(with_tables(f"""
    SELECT *, quarantined_records / bronze_records AS quarantine_rate,
      bronze_records = silver_records + quarantined_records AS reconciled_flag,
      bronze_records = silver_records + quarantined_records + collapsed_records AS balanced_flag
    FROM ({_balance('subjects', 'f_subjects', 'subjects_v', 'hist')}
          UNION ALL {_balance('visits', 'f_visits', 'visits_v', 'visits_ok')}
          UNION ALL {_balance('lab_results', 'f_labs', 'labs_v', 'labs_ok')}
          UNION ALL {_balance('adverse_events', 'f_adverse_events', 'events_v', 'events_ok')})""",
    "f_subjects", "f_visits", "f_labs", "f_adverse_events", "hist", "now", "visits_ok", "labs_ok", "events_ok"))
def reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    st = store(spark, sf)
    kept = conservation(st.history(), st.valid("subjects"), ["subject_id"], **silver.SUBJECT_HISTORY)
    layers = {
        entity: Layers(st.feed(feed), st.history() if feed == "subjects" else st.valid(feed),
                       st.rejected(feed), kept if feed == "subjects" else None)
        for feed, entity in ENTITIES.items()
    }
    return _plain(gold.reconciliation(layers, as_of()))
