"""Queries over the profiling and validation checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dqlake.functions import normalize_category, normalize_key
from dqlake.operators import (
    END, START, Relation, domain, duplicate_groups, gate, key_completeness, key_history,
    key_history_summary, layer_changes, lineage_completeness, mapping_coverage, missing_patterns, missing_values,
    order_profile, profile, quarantine_check, relation_profile, row_counts,
    sequence_duplicates, sum_constraint, trace,
)
from dqlake.plans import silver

from .feeds import TABLES, table
from .oracle import b2n, nk, with_tables
from .registry import query
from .silver_store import store


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES),
       name="row_counts")
def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return row_counts({t: table(spark, sf, t) for t in TABLES})


_VISIT_KEYS = ("visit_id", "subject_id", "study_id", "site_id")


def _missing_sql(cols, source: str, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {b2n(c)} IS NULL) AS missing_rows{extra.format(c=b2n(c))} "
        f"FROM {source}" for c in cols)


@query(with_tables(_missing_sql(_VISIT_KEYS, "f_visits"), "f_visits"), name="key_completeness")
def visit_key_completeness(spark: SparkSession, sf: str) -> DataFrame:
    return key_completeness(store(spark, sf).feed("visits"), _VISIT_KEYS)


_LAB_COLS = ("result_value", "result_unit", "reference_low", "reference_high", "abnormal_flag")


@query(with_tables(_missing_sql(_LAB_COLS, "f_labs",
                                ", (count(*) FILTER (WHERE {c} IS NULL)) / count(*) AS missing_rate"),
                   "f_labs"), name="missing_values")
def lab_missing_values(spark: SparkSession, sf: str) -> DataFrame:
    return missing_values(store(spark, sf).feed("labs"), _LAB_COLS)


@query(with_tables(f"""
    SELECT {nk('lab_result_id')} AS lab_result_id, count(*) AS row_count FROM f_labs
    WHERE {nk('lab_result_id')} IS NOT NULL GROUP BY 1 HAVING count(*) > 1""", "f_labs"),
    name="duplicate_groups")
def duplicate_labs(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_groups(store(spark, sf).feed("labs"), {"lab_result_id": normalize_key("lab_result_id")})


@query("""
    SELECT l_orderkey, CAST(sum(l_linenumber) AS BIGINT) AS total FROM lineitem GROUP BY 1
    HAVING abs(sum(l_linenumber) - 16) > 2.5""", name="sum_constraint")
def line_number_sums(spark: SparkSession, sf: str) -> DataFrame:
    return sum_constraint(table(spark, sf, "lineitem"), ["l_orderkey"], "l_linenumber", 16, 2.5)


_NO_TIME = "_source_file_name LIKE '%7.csv'"


@query(with_tables(f"""
    SELECT column_name, CAST(CASE column_name WHEN '_source_file' THEN no_file WHEN '_source_file_name' THEN no_name
        WHEN '_source_file_modification_ts' THEN no_time ELSE 0 END AS BIGINT) AS missing_rows, total_rows
    FROM (SELECT unnest(['_source_file', '_source_file_name', '_source_file_modification_ts', '_ingestion_ts', '_ingestion_date'])
            AS column_name, * FROM (
          SELECT count(*) AS total_rows, count(*) FILTER (WHERE _source_file_name IS NULL) AS no_name,
            count(*) FILTER (WHERE concat('landing/', _source_file_name) IS NULL) AS no_file,
            count(*) FILTER (WHERE {_NO_TIME}) AS no_time FROM events_v))""", "events_v"),
    name="lineage_completeness")
def event_lineage(spark: SparkSession, sf: str) -> DataFrame:
    """All five lineage columns; files of some days came without a modification time."""
    return lineage_completeness(store(spark, sf).adverse_events())


@query(with_tables(f"""
    SELECT * FROM (
      SELECT 'MULTIPLE_CURRENT_VERSIONS' AS failed_check, count(*) AS failed_rows FROM (
        SELECT subject_id FROM now GROUP BY 1 HAVING count(*) > 1)
      UNION ALL SELECT 'INVALID_SCD2_INTERVAL', count(*) FROM hist
        WHERE (end_date, end_file) <= (start_date, start_file)
      UNION ALL SELECT 'DUPLICATE_LAB_ID', count(*) FROM (
        SELECT {nk('lab_result_id')} FROM f_labs WHERE {nk('lab_result_id')} IS NOT NULL
        GROUP BY 1 HAVING count(*) > 1)
      UNION ALL SELECT 'UNMAPPED_SEX', count(*) FROM subjects_v WHERE sex = 'UNMAPPED')
    WHERE failed_rows > 0""", "hist", "now", "f_labs", "subjects_v"), name="gate")
def release_gate(spark: SparkSession, sf: str) -> DataFrame:
    st = store(spark, sf)
    history = st.history()
    return gate({
        "MULTIPLE_CURRENT_VERSIONS": duplicate_groups(
            history.where(F.col(END).isNull()), {"subject_id": F.col("subject_id")}),
        "INVALID_SCD2_INTERVAL": history.where(F.col(END) <= F.col(START)),
        "DUPLICATE_LAB_ID": duplicate_groups(
            st.feed("labs"), {"lab_result_id": normalize_key("lab_result_id")}),
        "UNMAPPED_SEX": st.subjects().where("sex = 'UNMAPPED'"),
    })


@query(f"""
    SELECT raw_value, record_count, coalesce(vals, '') AS mapped_values,
      CAST(coalesce(cnt, 0) AS INT) AS standard_value_count,
      CASE WHEN k IS NULL THEN 'UNMAPPED' WHEN cnt > 1 THEN 'AMBIGUOUS' ELSE 'MAPPED' END AS mapping_status
    FROM (SELECT {nk('p_name')} AS raw_value, count(*) AS record_count FROM part
          WHERE {nk('p_name')} IS NOT NULL GROUP BY 1)
    LEFT JOIN (SELECT CASE WHEN p_size >= 40 THEN {nk('p_name')} END AS k,
                 string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS vals,
                 count(DISTINCT p_type) AS cnt FROM part GROUP BY 1) ON raw_value = k""",
    name="mapping_coverage")
def part_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """Part names against a reference in which the smaller parts have no name."""
    part = table(spark, sf, "part")
    ref = part.select(F.when(F.col("p_size") >= 40, normalize_key("p_name")).alias("name"), "p_type")
    return mapping_coverage(part, normalize_key("p_name"), ref, "name", "p_type")


@query(with_tables(f"""
    SELECT raw_value, record_count, coalesce(v, '') AS mapped_values,
      CAST(CASE WHEN k IS NULL THEN 0 ELSE 1 END AS INT) AS standard_value_count,
      CASE WHEN k IS NULL THEN 'UNMAPPED' ELSE 'MAPPED' END AS mapping_status
    FROM (SELECT {nk('severity')} AS raw_value, count(*) AS record_count FROM f_adverse_events
          WHERE {nk('severity')} IS NOT NULL GROUP BY 1) LEFT JOIN r_sev ON raw_value = k""",
    "f_adverse_events", "r_sev"))
def mapping_coverage_severity(spark: SparkSession, sf: str) -> DataFrame:
    st = store(spark, sf)
    ref = st.references()["ref_severity"].select(
        normalize_key("raw_severity").alias("k"), normalize_category("standard_severity").alias("v"))
    return mapping_coverage(st.feed("adverse_events"), normalize_category("severity"), ref, "k", "v")


@query(with_tables(f"""
    SELECT count(*) AS total_rows, count(DISTINCT visit_id) AS distinct_keys,
      {', '.join(f'count(*) FILTER (WHERE {b2n(c)} IS NULL) AS missing_{c}' for c in _VISIT_KEYS)},
      count(*) FILTER (WHERE (visit_number IS NOT NULL AND TRY_CAST(visit_number AS INT) IS NULL)
        OR (days_from_baseline IS NOT NULL AND TRY_CAST(days_from_baseline AS INT) IS NULL)) AS rescued_rows,
      count(DISTINCT _source_file_name) AS source_files FROM f_visits""", "f_visits"),
    name="profile")
def visit_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile(store(spark, sf).feed("visits"), "visit_id", _VISIT_KEYS, "_source_file_name",
                   "_rescued_data")


_PATTERN = f"""CASE WHEN {b2n('result_value')} IS NULL AND {b2n('result_unit')} IS NULL
    THEN 'result_value+result_unit' WHEN {b2n('result_value')} IS NULL THEN 'result_value'
    WHEN {b2n('result_unit')} IS NULL THEN 'result_unit' ELSE 'complete' END"""


@query(with_tables(f"SELECT {_PATTERN} AS pattern, count(*) AS row_count FROM f_labs GROUP BY 1", "f_labs"),
       name="missing_patterns")
def lab_missing_patterns(spark: SparkSession, sf: str) -> DataFrame:
    return missing_patterns(store(spark, sf).feed("labs"), ["result_value", "result_unit"])


@query(with_tables(f"""
    SELECT lab_vendor, {_PATTERN} AS pattern, count(*) AS row_count FROM f_labs
    WHERE {_PATTERN} <> 'complete' GROUP BY 1, 2""", "f_labs"))
def missing_patterns_by_vendor(spark: SparkSession, sf: str) -> DataFrame:
    return missing_patterns(store(spark, sf).feed("labs"), ["result_value", "result_unit"],
                            by=["lab_vendor"], only_incomplete=True)


@query(with_tables("""
    SELECT subject_id, CAST(sum(k) AS BIGINT) AS row_count, count(*) AS file_count,
      string_agg(_source_file_name, ',' ORDER BY _source_file_name) AS files
    FROM (SELECT subject_id, _source_file_name, count(*) AS k FROM visits_v
          WHERE subject_id IS NOT NULL GROUP BY 1, 2) GROUP BY 1""", "visits_v"), name="key_history")
def subject_key_history(spark: SparkSession, sf: str) -> DataFrame:
    out = key_history(store(spark, sf).visits(), "subject_id", "_source_file_name")
    return out.withColumn("files", F.array_join("files", ","))


@query(with_tables("""
    SELECT count(*) AS distinct_keys, count(*) FILTER (WHERE r > 1) AS repeated_keys,
      count(*) FILTER (WHERE f > 1) AS keys_in_many_files, max(r) AS max_rows_per_key,
      max(f) AS max_files_per_key
    FROM (SELECT lab_result_id, count(*) AS r, count(DISTINCT _source_file_name) AS f FROM labs_v
          WHERE lab_result_id IS NOT NULL GROUP BY 1)""", "labs_v"), name="key_history_summary")
def lab_key_summary(spark: SparkSession, sf: str) -> DataFrame:
    return key_history_summary(store(spark, sf).labs(), "lab_result_id", "_source_file_name")


@query("""
    SELECT o_custkey, o_orderdate, count(*) AS row_count FROM orders GROUP BY 1, 2 HAVING count(*) > 1""",
    name="sequence_duplicates")
def order_sequence_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return sequence_duplicates(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate"])


@query(with_tables("""
    SELECT count(*) AS total_rows,
      count(*) FILTER (WHERE v.subject_id IS NULL) AS subject_missing,
      count(*) FILTER (WHERE v.subject_id IS NOT NULL AND n.subject_id IS NULL) AS subject_unknown,
      count(*) FILTER (WHERE v.study_id <> n.study_id) AS subject_study_id_mismatch,
      count(*) FILTER (WHERE v.site_id IS NULL) AS site_missing,
      count(*) FILTER (WHERE v.site_id IS NOT NULL AND s.k IS NULL) AS site_unknown,
      count(*) FILTER (WHERE v.study_id <> s.study) AS site_study_id_mismatch,
      count(*) FILTER (WHERE n.subject_id IS NOT NULL AND s.k IS NOT NULL AND coalesce(v.study_id = n.study_id, true)
        AND coalesce(v.study_id = s.study, true)) AS all_valid_rows
    FROM visits_v v LEFT JOIN now n ON v.subject_id = n.subject_id LEFT JOIN r_site s ON v.site_id = s.k""",
    "visits_v", "now", "r_site"), name="relation_profile")
def visit_relations(spark: SparkSession, sf: str) -> DataFrame:
    st = store(spark, sf)
    visits = st.visits().select("subject_id", "study_id", "site_id")
    return relation_profile(visits, [
        Relation("subject", silver.trusted_subjects(st.history()), {"subject_id": "_subject_key"},
                 {"study_id": "_subject_study"}, unique=True),
        Relation("site", silver.site_ref(st.references()), {"site_id": "_site_key"},
                 {"study_id": "_site_study"}, unique=True),
    ])


_PAIRS = [("screening_date", "enrollment_date"), ("informed_consent_date", "enrollment_date"),
          ("enrollment_date", "discontinuation_date"), ("randomization_date", "discontinuation_date")]


@query(with_tables(" UNION ALL ".join(
    f"SELECT '{a}>{b}' AS pair, count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) "
    f"AS comparable_rows, count(*) FILTER (WHERE {a} > {b}) AS violations FROM subjects_v"
    for a, b in _PAIRS), "subjects_v"), name="order_profile")
def subject_order_profile(spark: SparkSession, sf: str) -> DataFrame:
    return order_profile(store(spark, sf).subjects(), _PAIRS)


_DOMAIN = ("outcome", "serious_flag", "severity_rank", "action_taken")


@query(with_tables(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS STRING) AS value, count(*) AS row_count FROM events_v GROUP BY 1, 2"
    for c in _DOMAIN), "events_v"), name="domain")
def event_domains(spark: SparkSession, sf: str) -> DataFrame:
    return domain(store(spark, sf).adverse_events(), _DOMAIN)


@query(with_tables("""
    SELECT count(*) AS quarantine_rows, count(*) FILTER (WHERE trim(why) = '') AS missing_reason_rows,
      count(DISTINCT _source_file_name) AS affected_files FROM visits_v WHERE why <> ''""", "visits_v"),
    name="quarantine_check")
def visit_quarantine_check(spark: SparkSession, sf: str) -> DataFrame:
    return quarantine_check(store(spark, sf).rejected("visits"))


def _trace_sql(layer: str, source: str) -> str:
    return (f"SELECT subject_id, count(*) AS row_count, '{layer}' AS layer FROM {source} "
            "WHERE subject_id IN (SELECT subject_id FROM subjects_v WHERE why LIKE '%unmappable_sex%') "
            "GROUP BY 1")


@query(with_tables(" UNION ALL ".join([
    _trace_sql("bronze", "subjects_typed"), _trace_sql("silver", "hist"),
    _trace_sql("quarantine", "(SELECT * FROM subjects_v WHERE why <> '')"), _trace_sql("gold", "spine")]),
    "subjects_typed", "hist", "subjects_v", "spine"), name="trace")
def trace_unmappable(spark: SparkSession, sf: str) -> DataFrame:
    """Every subject that was once rejected for its sex value, through all layers."""
    st = store(spark, sf)
    rejected = st.rejected("subjects")
    wanted = rejected.where(F.array_contains("_dq_failures", "unmappable_sex"))
    bronze = st.feed("subjects").select(normalize_key("subject_id").alias("subject_id"))
    return trace(wanted, {"bronze": bronze, "silver": st.history(), "quarantine": rejected,
                          "gold": st.spine()}, "subject_id")


# The controlled delivery: five new subjects, of which two must be rejected, each by its own rule.
_DEMO = [("DEMO06", "ENROLLED", "33"), ("DEMO07", "ENROLLED", "46"), ("DEMO08", "SCREENING", "31"), ("DEMO09", "ENROLLED", "16"),
         ("DEMO10", "ACTIVE", "50")]
_DEMO_FILE = "subjects_20240620.csv"


@query(with_tables(f"""
    SELECT layer, subject_id, '{_DEMO_FILE}' AS _source_file_name, CAST(0 AS BIGINT) AS rows_before, CAST(1 AS BIGINT) AS rows_after,
      'new' AS change, CAST(NULL AS STRING) AS moved_from
    FROM (SELECT unnest(['DEMO06', 'DEMO07', 'DEMO08', 'DEMO09', 'DEMO10']) AS subject_id) d
    JOIN (SELECT 'bronze' AS layer UNION ALL SELECT 'silver' UNION ALL SELECT 'quarantine') l
      ON layer = 'bronze' OR (layer = 'quarantine') = (subject_id IN ('DEMO09', 'DEMO10'))
    WHERE (SELECT count(*) FROM f_subjects) > 0""", "f_subjects"), name="layer_changes")
def controlled_delivery(spark: SparkSession, sf: str) -> DataFrame:
    """All three layers before and after the controlled file: three rows go through, two do not, none else moves."""
    st = store(spark, sf)
    site, arm = (st.references()[k] for k in ("dim_site", "dim_study_arm"))
    given = arm.join(site, "study_id").select("site_id", "study_id", "arm_code").orderBy("site_id", "arm_code").limit(1)
    demo = given.select("site_id", "study_id", "arm_code", F.explode(F.array(*[
        F.struct(F.lit(i).alias("subject_id"), F.lit(w).alias("subject_status"), F.lit(a).alias("age")) for i, w, a in _DEMO])).alias("d"))
    demo = demo.select("d.*", "site_id", "study_id", "arm_code", F.lit("F").alias("sex"), F.lit("2024-05-01").alias("screening_date"),
                       F.lit("2024-05-01").alias("informed_consent_date"), F.lit("2024-05-10").alias("enrollment_date"),
                       F.lit("2024-05-11").alias("randomization_date"), F.lit(_DEMO_FILE).alias("_source_file_name"))
    raw = st.feed("subjects")
    grown = raw.unionByName(demo, allowMissingColumns=True)
    checked = st.kept("subjects_with_demo", lambda: silver.validate_subjects(grown, st.references()))

    def layers(bronze: DataFrame, validated: DataFrame) -> dict[str, DataFrame]:
        return {"bronze": bronze.select(normalize_key("subject_id").alias("subject_id"), "_source_file_name"),
                "silver": validated.where("_is_valid"), "quarantine": validated.where("not _is_valid")}

    return layer_changes(layers(raw, st.subjects()), layers(grown, checked), "subject_id", "_source_file_name")

