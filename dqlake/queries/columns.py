"""Queries over column expressions: normalising, typing, measures."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from dqlake.functions import (
    band, blank_to_null, delivery_date, elapsed_days, map_flag, map_values, n, normalize_category,
    normalize_key, normalize_unit, parse_date, stamp, typed,
)
from dqlake.operators import conversion_coverage, crosstab, parse_coverage
from dqlake.plans import schemas as s

from .feeds import table
from .oracle import b2n, nk, with_tables
from .registry import query
from .silver_store import store


@query(with_tables(f"""
    SELECT subject_id AS raw_subject_id, {b2n('subject_id')} AS subject_text,
           {nk('subject_id')} AS subject_key, {nk('visit_name')} AS visit_name FROM f_visits""",
    "f_visits"))
def normalize_keys(spark: SparkSession, sf: str) -> DataFrame:
    return store(spark, sf).feed("visits").select(
        F.col("subject_id").alias("raw_subject_id"),
        blank_to_null("subject_id").alias("subject_text"),
        normalize_key("subject_id").alias("subject_key"),
        normalize_category("visit_name").alias("visit_name"),
    )


@query(with_tables(r"""
    SELECT TRY_CAST(age AS INT) AS age, TRY_CAST(screening_date AS DATE) AS screening_date,
      TRY_CAST(enrollment_date AS DATE) AS enrollment_date,
      CAST(try_strptime(regexp_extract(_source_file_name, '^subjects_([0-9]{8})\.csv$', 1),
                        '%Y%m%d') AS DATE) AS delivered
    FROM f_subjects""", "f_subjects"))
def typed_parse(spark: SparkSession, sf: str) -> DataFrame:
    out = typed(store(spark, sf).feed("subjects"),
                {"age": "int", "screening_date": "date", "enrollment_date": "date"})
    return out.select("age", "screening_date", "enrollment_date",
                      delivery_date("_source_file_name", "subjects").alias("delivered"))


@query(with_tables(f"""
    SELECT collection_date AS raw, CAST(try_strptime({b2n('collection_date')}, '%d-%b-%Y') AS DATE)
      AS collection_date, count(*) AS row_count FROM f_labs GROUP BY 1, 2""", "f_labs"))
def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    return (store(spark, sf).feed("labs")
            .groupBy(F.col("collection_date").alias("raw"),
                     parse_date("collection_date", s.LAB_DATE_FORMAT).alias("collection_date"))
            .agg(n().alias("row_count")))


def _coverage(fmt: str) -> str:
    parsed = f"CAST(try_strptime({b2n('onset_date')}, '{fmt}') AS DATE)"
    return with_tables(f"""
        SELECT count(*) AS total_rows,
          count(*) FILTER (WHERE {b2n('onset_date')} IS NULL) AS missing_rows,
          count(*) FILTER (WHERE {b2n('onset_date')} IS NOT NULL AND {parsed} IS NULL)
            AS unparseable_rows,
          min({parsed}) AS min_date, max({parsed}) AS max_date FROM f_adverse_events""",
        "f_adverse_events")


@query(_coverage("%Y-%m-%d"), name="parse_coverage")
def parse_coverage_iso(spark: SparkSession, sf: str) -> DataFrame:
    return parse_coverage(store(spark, sf).feed("adverse_events"), "onset_date", "yyyy-MM-dd")


@query(_coverage("%d-%b-%Y"))
def parse_coverage_month_name(spark: SparkSession, sf: str) -> DataFrame:
    return parse_coverage(store(spark, sf).feed("adverse_events"), "onset_date", s.LAB_DATE_FORMAT)


@query(with_tables(f"""
    SELECT visit_status AS source_status,
      CASE WHEN {nk('visit_status')} IN ('COMPLETED', 'COMPLETE', 'DONE') THEN 'COMPLETED'
           WHEN {nk('visit_status')} IS NULL OR {nk('visit_status')} = '?' THEN 'UNKNOWN'
           ELSE {nk('visit_status')} END AS visit_status,
      CASE WHEN {nk('visit_status')} IN ('COMPLETED', 'COMPLETE', 'DONE') THEN 'HELD'
           WHEN {nk('visit_status')} IS NULL THEN 'NONE' ELSE 'OTHER' END AS attendance,
      count(*) AS row_count FROM f_visits GROUP BY 1, 2, 3""", "f_visits"))
def map_status(spark: SparkSession, sf: str) -> DataFrame:
    status = map_values("visit_status", s.VISIT_STATUS_WORDS, null_as="UNKNOWN")
    held = map_values("visit_status", {"HELD": s.VISIT_STATUS_WORDS["COMPLETED"]}, null_as="NONE",
                      default="OTHER")
    return (store(spark, sf).feed("visits")
            .groupBy(F.col("visit_status").alias("source_status"), status.alias("visit_status"),
                     held.alias("attendance"))
            .agg(n().alias("row_count")))


@query(with_tables(f"""
    SELECT serious_flag AS source_serious_flag,
      CASE WHEN {nk('serious_flag')} IN ('Y', 'YES', '1', 'TRUE') THEN 'YES'
           WHEN {nk('serious_flag')} IN ('N', 'NO', '0', 'FALSE') THEN 'NO' END AS serious_flag,
      count(*) AS row_count FROM f_adverse_events GROUP BY 1, 2""", "f_adverse_events"),
    name="map_flag")
def map_flags(spark: SparkSession, sf: str) -> DataFrame:
    return (store(spark, sf).feed("adverse_events")
            .groupBy(F.col("serious_flag").alias("source_serious_flag"),
                     map_flag("serious_flag").alias("serious_flag"))
            .agg(n().alias("row_count")))


@query(f"""
    SELECT upper(trim(p_name)) AS unit, replace(upper(trim(p_name)), ' ', '') AS unit_no_space,
      count(*) AS row_count FROM part GROUP BY 1, 2""")
def unit_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return (table(spark, sf, "part")
            .groupBy(normalize_unit("p_name").alias("unit"),
                     normalize_unit("p_name", strip_ws=True).alias("unit_no_space"))
            .agg(n().alias("row_count")))


@query("""
    SELECT o_orderkey,
      CASE WHEN p_size IS NULL THEN 'UNKNOWN' WHEN p_size < 10 THEN '<10' WHEN p_size < 30 THEN '10-30'
           ELSE '>=30' END AS size_band,
      CAST(date_diff('day', CAST(o_orderdate AS DATE), CASE WHEN o_orderstatus = 'F'
           THEN CAST(o_orderdate AS DATE) + 9 ELSE DATE '2024-06-30' END) AS INT) AS days_open,
      CAST(TIMESTAMP '2024-06-30' AS DATE) AS audit_date
    FROM orders LEFT JOIN part ON o_custkey = p_partkey""")
def band_elapsed(spark: SparkSession, sf: str) -> DataFrame:
    orders, part = table(spark, sf, "orders"), table(spark, sf, "part")
    day = F.col("o_orderdate").cast("date")
    closed = F.when(F.col("o_orderstatus") == "F", F.date_add(day, 9))
    as_of = F.lit(date(2024, 6, 30))
    out = orders.join(part, orders["o_custkey"] == part["p_partkey"], "left").select(
        "o_orderkey", band("p_size", [10, 30]).alias("size_band"),
        elapsed_days(day, closed, as_of).alias("days_open"))
    return stamp(out, "audit_date", as_of).withColumn("audit_date", F.col("audit_date").cast("date"))


@query(with_tables("""
    SELECT lab_result_id, lab_test_code, result_value, result_unit, sv AS standardized_result_value,
      standard_unit, f AS conversion_factor, lo AS standard_reference_low,
      hi AS standard_reference_high, derived_abnormal_flag, derived_direction,
      discrepancy AS abnormal_flag_discrepancy FROM labs_v""", "labs_v"))
def measure_standardise(spark: SparkSession, sf: str) -> DataFrame:
    return store(spark, sf).labs().select(
        "lab_result_id", "lab_test_code", "result_value", "result_unit",
        "standardized_result_value", "standard_unit", "conversion_factor",
        "standard_reference_low", "standard_reference_high", "derived_abnormal_flag",
        "derived_direction", "abnormal_flag_discrepancy")


@query(with_tables("""
    SELECT source_abnormal_flag, derived_direction, count(*) AS row_count FROM labs_v GROUP BY 1, 2""",
    "labs_v"))
def flag_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return crosstab(store(spark, sf).labs(), "source_abnormal_flag", "derived_direction")


@query(with_tables("""
    SELECT standard_severity, serious_flag, count(*) AS row_count FROM events_v GROUP BY 1, 2""",
    "events_v"))
def severity_seriousness_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return crosstab(store(spark, sf).adverse_events(), "standard_severity", "serious_flag")


@query(with_tables("""
    SELECT count(*) AS total_rows, count(DISTINCT lab_result_id) AS distinct_keys,
      count(*) FILTER (WHERE result_value IS NOT NULL AND result_unit IS NOT NULL AND f IS NULL)
        AS unmapped_complete_measurements,
      count(*) FILTER (WHERE f <> 1) AS converted_measurements,
      count(*) FILTER (WHERE result_value IS NOT NULL AND f IS NOT NULL AND sv IS NULL)
        AS failed_standardizations
    FROM labs_v""", "labs_v"), name="conversion_coverage")
def conversions(spark: SparkSession, sf: str) -> DataFrame:
    return conversion_coverage(store(spark, sf).labs(), "lab_result_id")
