"""SQL twins of the derived trusted tables, written without the library."""

from __future__ import annotations

from .feeds import AS_OF, REFERENCE_SQL, feed_sql

DAY = f"DATE '{AS_OF}'"


def b2n(x: str) -> str:
    return f"nullif(nullif(trim({x}), ''), '-')"


def nk(x: str) -> str:
    return f"upper({b2n(x)})"


def ratio(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN {num} / {den} END"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def reasons(rules: list[tuple[str, str]]) -> str:
    return "concat_ws(';', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in rules) + ")"


SUBJECT_RULES = [
    ("missing_subject_id", "subject_id IS NULL"),
    ("missing_study_id", "study_id IS NULL"),
    ("unknown_study_id", "study_id IS NOT NULL AND st.k IS NULL"),
    ("missing_site_id", "site_id IS NULL"),
    ("unknown_site_id", "site_id IS NOT NULL AND si.k IS NULL"),
    ("site_not_in_study", "si.study <> study_id"),
    ("age_out_of_range", "age IS NULL OR age < 18 OR age > 100"),
    ("unmappable_sex", "sex_key IS NOT NULL AND sx.k IS NULL"),
    ("unknown_baseline_condition", "baseline_condition_code IS NOT NULL AND dx.k IS NULL"),
    ("invalid_source_snapshot_date", "source_snapshot_date IS NULL"),
    ("missing_screening_date", "screening_date IS NULL"),
    ("enrollment_before_screening", "enrollment_date < screening_date"),
    ("consent_after_enrollment", "informed_consent_date > enrollment_date"),
    ("randomization_before_enrollment", "randomization_date < enrollment_date"),
    ("discontinuation_before_enrollment", "discontinuation_date < enrollment_date"),
    ("discontinuation_before_randomization", "discontinuation_date < randomization_date"),
    ("invalid_subject_status", "subject_status IS NULL OR subject_status NOT IN "
     "('SCREENING','ENROLLED','SCREEN_FAILED','DISCONTINUED','COMPLETED')"),
    ("enrolled_without_arm",
     "subject_status IN ('ENROLLED','DISCONTINUED','COMPLETED') AND arm_code IS NULL"),
    ("unknown_arm_code", "arm_code IS NOT NULL AND ar.a IS NULL"),
]
VISIT_RULES = [
    ("missing_visit_id", "visit_id IS NULL"),
    ("missing_subject_id", "v.subject_id IS NULL"),
    ("unknown_silver_subject", "v.subject_id IS NOT NULL AND su.subject_id IS NULL"),
    ("missing_study_id", "v.study_id IS NULL"),
    ("unknown_study_id", "v.study_id IS NOT NULL AND st.k IS NULL"),
    ("missing_site_id", "v.site_id IS NULL"),
    ("unknown_site_id", "v.site_id IS NOT NULL AND si.k IS NULL"),
    ("site_not_in_study", "si.study <> v.study_id"),
    ("subject_not_in_study", "su.study_id <> v.study_id"),
    ("subject_not_in_site", "su.site_id <> v.site_id"),
    ("invalid_visit_status", "visit_status NOT IN ('COMPLETED','MISSED','RESCHEDULED')"),
    ("completed_visit_missing_date", "visit_status = 'COMPLETED' AND visit_date IS NULL"),
]
EVENT_RULES = [
    ("missing_ae_id", "ae_id IS NULL"),
    ("missing_subject_id", "v.subject_id IS NULL"),
    ("unknown_silver_subject", "v.subject_id IS NOT NULL AND su.subject_id IS NULL"),
    ("subject_study_mismatch", "su.study_id <> v.study_id"),
    ("subject_site_mismatch", "su.site_id <> v.site_id"),
    ("missing_study_id", "v.study_id IS NULL"),
    ("missing_site_id", "v.site_id IS NULL"),
    ("unknown_site_id", "v.site_id IS NOT NULL AND si.k IS NULL"),
    ("site_study_mismatch", "si.study <> v.study_id"),
    ("invalid_onset_date", "raw_onset IS NOT NULL AND onset_date IS NULL"),
]
LAB_RULES = [
    ("missing_lab_result_id", "lab_result_id IS NULL"),
    ("missing_subject_id", "v.subject_id IS NULL"),
    ("unknown_silver_subject", "v.subject_id IS NOT NULL AND su.subject_id IS NULL"),
    ("subject_study_mismatch", "su.study_id <> v.study_id"),
    ("missing_study_id", "v.study_id IS NULL"),
    ("missing_visit_id", "v.visit_id IS NULL"),
    ("unknown_silver_visit", "v.visit_id IS NOT NULL AND vi.visit_id IS NULL"),
    ("visit_subject_mismatch", "vi.subject_id <> v.subject_id"),
    ("visit_study_mismatch", "vi.study_id <> v.study_id"),
    ("missing_lab_test_code", "v.lab_test_code IS NULL"),
    ("unknown_lab_test_code", "v.lab_test_code IS NOT NULL AND lt.k IS NULL"),
    ("missing_result_value", "result_value IS NULL"),
    ("missing_result_unit", "result_unit IS NULL"),
    ("unmapped_test_unit", "result_value IS NOT NULL AND result_unit IS NOT NULL AND f IS NULL"),
    ("invalid_standard_reference_range",
     "lt.k IS NOT NULL AND (lt.lo IS NULL OR lt.hi IS NULL OR lt.lo > lt.hi)"),
    ("invalid_collection_date", "collection_date IS NULL"),
]

TRACKED = ("study_id site_id screening_date enrollment_date subject_status age sex "
           "baseline_condition_code baseline_condition arm_code randomization_date "
           "informed_consent_date discontinuation_date discontinuation_reason").split()
_STATE = ", ".join(TRACKED)
_STATE_DESC = ", ".join(f"{c} DESC NULLS LAST" for c in TRACKED)
_SUBJECT_DATES = ("screening_date", "enrollment_date", "randomization_date",
                  "informed_consent_date", "discontinuation_date")
_DIRECTION = ("CASE WHEN sv IS NULL OR lo IS NULL OR hi IS NULL THEN NULL WHEN sv < lo THEN 'LOW' "
              "WHEN sv > hi THEN 'HIGH' ELSE 'NORMAL' END")


def history_sql(valid: str, key: str = "subject_id") -> str:
    """Versions of a change feed: number the runs of equal state, then group them."""
    return f"""
    SELECT {key}, {', '.join(f'any_value({c}) AS {c}' for c in TRACKED)},
           any_value(first_date) AS start_date, any_value(first_file) AS start_file,
           arg_max(_source_file, (source_snapshot_date, _source_file_name)) AS _source_file,
           count(*) AS n_rows, run
    FROM (
      SELECT *, first_value(source_snapshot_date) OVER g AS first_date,
             first_value(_source_file_name) OVER g AS first_file
      FROM (
        SELECT *, sum(opens) OVER (PARTITION BY {key}
                                   ORDER BY source_snapshot_date, _source_file_name) AS run
        FROM (
          SELECT *, CASE WHEN state IS DISTINCT FROM lag(state) OVER (
                    PARTITION BY {key} ORDER BY source_snapshot_date, _source_file_name)
                    THEN 1 ELSE 0 END AS opens
          FROM (SELECT *, row({_STATE}) AS state, row_number() OVER (
                  PARTITION BY {key}, source_snapshot_date, _source_file_name
                  ORDER BY {_STATE_DESC}) AS rn FROM {valid})
          WHERE rn = 1))
      WINDOW g AS (PARTITION BY {key}, run ORDER BY source_snapshot_date, _source_file_name))
    GROUP BY {key}, run"""


# name -> (tables it reads, SQL)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    **{name: ((), sql) for name, sql in REFERENCE_SQL.items()},
    **{f"f_{name}": ((), feed_sql(name)) for name in ("subjects", "visits", "labs", "adverse_events")},
    "r_study": (("dim_study",), f"SELECT DISTINCT {nk('study_id')} AS k FROM dim_study"),
    "r_site": (("dim_site",), f"SELECT {nk('site_id')} AS k, max({nk('study_id')}) AS study "
                              f"FROM dim_site GROUP BY 1"),
    "r_arm": (("dim_study_arm",), f"SELECT DISTINCT {nk('study_id')} AS s, {nk('arm_code')} AS a "
                                  f"FROM dim_study_arm"),
    "r_sex": (("ref_sex",), f"SELECT {nk('raw_sex')} AS k, max({nk('standard_sex')}) AS v "
                            f"FROM ref_sex GROUP BY 1"),
    "r_dx": (("ref_diagnosis",), f"SELECT {nk('diagnosis_code')} AS k, "
                                 f"max({b2n('diagnosis_description')}) AS v FROM ref_diagnosis GROUP BY 1"),
    "r_sev": (("ref_severity",), f"SELECT {nk('raw_severity')} AS k, max({nk('standard_severity')}) AS v, "
                                 f"max(CAST(severity_rank AS INT)) AS rk FROM ref_severity GROUP BY 1"),
    "r_test": (("ref_lab_test",), f"SELECT {nk('lab_test_code')} AS k, max(standard_unit) AS unit, "
                                  "max(CAST(reference_low AS DOUBLE)) AS lo, "
                                  "max(CAST(reference_high AS DOUBLE)) AS hi FROM ref_lab_test GROUP BY 1"),
    "r_unit": (("ref_unit",), f"SELECT {nk('lab_test_code')} AS t, {nk('raw_unit')} AS u, "
                              "max(standard_unit) AS unit, max(CAST(conversion_factor AS DOUBLE)) AS f "
                              "FROM ref_unit GROUP BY 1, 2"),
    "subjects_typed": (("f_subjects",), f"""
        SELECT {', '.join(f"{nk(c)} AS {c}" for c in (
            'subject_id', 'study_id', 'site_id', 'arm_code', 'subject_status',
            'baseline_condition_code', 'discontinuation_reason'))},
          {nk('sex')} AS sex_key, TRY_CAST(age AS INT) AS age,
          {', '.join(f'TRY_CAST({c} AS DATE) AS {c}' for c in _SUBJECT_DATES)},
          CAST(try_strptime(regexp_extract(_source_file_name,
               '^subjects_([0-9]{{8}})\\.csv$', 1), '%Y%m%d') AS DATE) AS source_snapshot_date,
          _source_file_name, concat('landing/', _source_file_name) AS _source_file
        FROM f_subjects"""),
    "subjects_v": (("subjects_typed", "r_study", "r_site", "r_arm", "r_sex", "r_dx"), f"""
        SELECT t.* EXCLUDE (sex_key),
          CASE WHEN sex_key IS NOT NULL THEN coalesce(sx.v, 'UNMAPPED') END AS sex,
          dx.v AS baseline_condition, {reasons(SUBJECT_RULES)} AS why
        FROM subjects_typed t LEFT JOIN r_study st ON study_id = st.k
          LEFT JOIN r_site si ON site_id = si.k LEFT JOIN r_arm ar ON study_id = ar.s AND arm_code = ar.a
          LEFT JOIN r_sex sx ON sex_key = sx.k LEFT JOIN r_dx dx ON baseline_condition_code = dx.k"""),
    "subjects_ok": (("subjects_v",), "SELECT * FROM subjects_v WHERE why = ''"),
    "hist_runs": (("subjects_ok",), history_sql("subjects_ok")),
    "hist": (("hist_runs",), """
        SELECT *, lead(start_date) OVER w AS end_date, lead(start_file) OVER w AS end_file
        FROM hist_runs WINDOW w AS (PARTITION BY subject_id ORDER BY run)"""),
    "now": (("hist",), "SELECT * FROM hist WHERE end_date IS NULL"),
    "visits_v": (("f_visits", "r_study", "r_site", "now"), f"""
        SELECT v.*, {reasons(VISIT_RULES)} AS why FROM (
          SELECT {', '.join(f"{nk(c)} AS {c}" for c in (
              'visit_id', 'subject_id', 'study_id', 'site_id', 'visit_name'))},
            TRY_CAST(visit_number AS INT) AS visit_number, TRY_CAST(visit_date AS DATE) AS visit_date,
            CASE WHEN {nk('visit_status')} IN ('COMPLETED', 'COMPLETE', 'DONE') THEN 'COMPLETED'
                 WHEN {nk('visit_status')} IS NULL OR {nk('visit_status')} = '?' THEN 'UNKNOWN'
                 ELSE {nk('visit_status')} END AS visit_status,
            TRY_CAST(days_from_baseline AS INT) AS days_from_baseline, _source_file_name
          FROM f_visits) v
        LEFT JOIN r_study st ON v.study_id = st.k LEFT JOIN r_site si ON v.site_id = si.k
        LEFT JOIN now su ON v.subject_id = su.subject_id"""),
    "visits_ok": (("visits_v",), "SELECT * FROM visits_v WHERE why = ''"),
    "r_visit": (("visits_ok",), "SELECT visit_id, max(subject_id) AS subject_id, "
                                "max(study_id) AS study_id FROM visits_ok GROUP BY 1"),
    "events_v": (("f_adverse_events", "r_sev", "r_site", "now"), f"""
        SELECT v.* EXCLUDE (sev_key), sv.v AS standard_severity, sv.rk AS severity_rank,
          {reasons(EVENT_RULES)} AS why FROM (
          SELECT {', '.join(f"{nk(c)} AS {c}" for c in (
              'ae_id', 'subject_id', 'study_id', 'site_id', 'outcome', 'related_to_study_drug',
              'action_taken'))},
            {b2n('ae_term')} AS ae_term, {b2n('meddra_soc')} AS meddra_soc,
            {b2n('severity')} AS source_severity, {nk('severity')} AS sev_key,
            {nk('serious_flag')} AS source_serious_flag,
            CASE WHEN {nk('serious_flag')} IN ('Y', 'YES', '1', 'TRUE') THEN 'YES'
                 WHEN {nk('serious_flag')} IN ('N', 'NO', '0', 'FALSE') THEN 'NO' END AS serious_flag,
            {b2n('onset_date')} AS raw_onset,
            CAST(try_strptime({b2n('onset_date')}, '%Y-%m-%d') AS DATE) AS onset_date,
            CAST(try_strptime({b2n('resolution_date')}, '%Y-%m-%d') AS DATE) AS resolution_date,
            _source_file_name
          FROM f_adverse_events) v
        LEFT JOIN r_sev sv ON v.sev_key = sv.k LEFT JOIN r_site si ON v.site_id = si.k
        LEFT JOIN now su ON v.subject_id = su.subject_id"""),
    "events_ok": (("events_v",), "SELECT * FROM events_v WHERE why = ''"),
    "labs_v": (("f_labs", "r_test", "r_unit", "now", "r_visit"), f"""
        SELECT *, CASE WHEN sv IS NULL OR lo IS NULL OR hi IS NULL THEN NULL
                       WHEN sv < lo OR sv > hi THEN 'Y' ELSE 'N' END AS derived_abnormal_flag,
          {_DIRECTION} AS derived_direction,
          CASE WHEN source_abnormal_flag IN ('Y', 'N') AND sv IS NOT NULL AND lo IS NOT NULL
                    AND hi IS NOT NULL
               THEN (source_abnormal_flag = 'Y') <> (sv < lo OR sv > hi) END AS discrepancy
        FROM (
          SELECT v.*, lt.lo, lt.hi, un.f, coalesce(un.unit, lt.unit) AS standard_unit,
            result_value * un.f AS sv, {reasons(LAB_RULES)} AS why FROM (
            SELECT {', '.join(f"{nk(c)} AS {c}" for c in (
                'lab_result_id', 'subject_id', 'study_id', 'visit_id', 'lab_test_code', 'lab_vendor'))},
              {b2n('lab_test_name')} AS lab_test_name, {b2n('result_unit')} AS result_unit,
              {nk('result_unit')} AS unit_key, TRY_CAST(result_value AS DOUBLE) AS result_value,
              TRY_CAST(reference_low AS DOUBLE) AS source_reference_low,
              TRY_CAST(reference_high AS DOUBLE) AS source_reference_high,
              {nk('abnormal_flag')} AS source_abnormal_flag,
              CAST(try_strptime({b2n('collection_date')}, '%d-%b-%Y') AS DATE) AS collection_date,
              _source_file_name
            FROM f_labs) v
          LEFT JOIN r_test lt ON v.lab_test_code = lt.k
          LEFT JOIN r_unit un ON v.lab_test_code = un.t AND v.unit_key = un.u
          LEFT JOIN now su ON v.subject_id = su.subject_id
          LEFT JOIN r_visit vi ON v.visit_id = vi.visit_id)"""),
    "labs_ok": (("labs_v",), "SELECT * FROM labs_v WHERE why = ''"),
    "spine": (("hist", "now"), f"""
        SELECT n.subject_id, {', '.join('n.' + c for c in TRACKED if c != 'subject_status')},
          n.subject_status AS current_subject_status, h.* EXCLUDE (subject_id),
          CASE WHEN age < 65 THEN '<65' WHEN age >= 65 THEN '>=65' ELSE 'UNKNOWN' END AS age_group,
          CAST(date_diff('day', screening_date, coalesce(discontinuation_date, {DAY})) AS INT)
            AS days_on_study
        FROM now n LEFT JOIN (
          SELECT subject_id,
            max(CASE WHEN screening_date IS NOT NULL THEN 1 ELSE 0 END) AS ever_screened_flag,
            max(CASE WHEN enrollment_date IS NOT NULL THEN 1 ELSE 0 END) AS ever_enrolled_flag,
            max(CASE WHEN randomization_date IS NOT NULL THEN 1 ELSE 0 END) AS ever_randomized_flag,
            max(CASE WHEN subject_status = 'COMPLETED' THEN 1 ELSE 0 END) AS ever_completed_flag,
            max(CASE WHEN discontinuation_date IS NOT NULL
                     OR subject_status IN ('DISCONTINUED', 'WITHDRAWN') THEN 1 ELSE 0 END)
              AS ever_discontinued_flag,
            max(CASE WHEN subject_status = 'SCREEN_FAILED' THEN 1 ELSE 0 END) AS ever_screen_failed_flag,
            count(*) AS subject_version_count,
            min(start_date) AS first_version_at, max(start_date) AS last_version_at
          FROM hist GROUP BY 1) h ON n.subject_id = h.subject_id"""),
}


def with_tables(select: str, *names: str) -> str:
    """``select`` preceded by the named CTEs and everything they read."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for dep in CTES[name][0]:
                add(dep)
            order.append(name)

    for name in names:
        add(name)
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name][1]})" for name in order)
    return f"WITH {ctes}\n{select}"
