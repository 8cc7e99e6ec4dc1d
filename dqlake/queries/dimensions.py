"""Dimension and reference tables from dirty, repeated deliveries.

Every key is delivered several times, under different files; the expressions of the deliveries are SQL
that both engines share, the rules of the tables are written once in the library and once here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dqlake.plans import schemas as s, silver

from .feeds import AS_OF, table
from .oracle import b2n, nk
from .registry import query

# Table, deliveries and the given table they come from.
_DELIVERED = {
    "dim_site": ("supplier", {
        "site_id": "CASE WHEN s_suppkey % 29 = 0 THEN '-' ELSE concat(' s-', CAST(s_suppkey % 60 AS STRING)) END",
        "study_id": "concat('st-', CAST(s_nationkey % 5 AS STRING), ' ')",
        "institution_id": "CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE concat('inst-', CAST(s_nationkey AS STRING)) END",
        "site_name": "concat(' ', s_name)", "country": "concat('country ', CAST(s_nationkey % 6 AS STRING))",
        "city": "concat(' City ', CAST(s_suppkey % 4 AS STRING))", "principal_investigator": "concat('Dr ', CAST(s_suppkey AS STRING))",
        "target_subjects": "CASE WHEN s_suppkey % 11 = 0 THEN 'x' ELSE CAST(s_suppkey % 90 AS STRING) END",
        "activation_date": "CASE WHEN s_suppkey % 13 = 0 THEN 'bad' ELSE '2024-01-05' END",
        "site_status": "CASE WHEN s_suppkey % 3 = 0 THEN ' active' ELSE 'Closed' END"},
        "concat('sites_', CAST(s_suppkey % 9 AS STRING), '.csv')"),
    "dim_study": ("customer", {
        "study_id": "CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE concat('st-', CAST(c_custkey % 50 AS STRING)) END",
        "study_name": "concat(c_name, ' ')", "protocol_number": "concat('PR-', CAST(c_custkey AS STRING))",
        "therapeutic_area": "lower(c_mktsegment)", "phase": "'II'", "indication_code": "concat('D00', CAST(c_custkey % 9 AS STRING))",
        "sponsor_id": "CASE WHEN c_custkey % 4 = 0 THEN '-' ELSE concat('sp-', CAST(c_nationkey AS STRING)) END",
        "target_enrollment": "CAST(c_nationkey * 10 AS STRING)", "planned_start_date": "'2024-01-01'",
        "planned_end_date": "CASE WHEN c_custkey % 5 = 0 THEN '2026-02-30' ELSE '2026-02-28' END", "study_status": "' open'",
        "protocol_version": "CAST(c_custkey % 3 AS STRING)"},
        "concat('studies_', CAST(c_custkey % 17 AS STRING), '.csv')"),
    "dim_study_arm": ("customer", {
        "study_id": "concat(' st-', CAST(c_custkey % 20 AS STRING))", "arm_code": "concat(lower(c_mktsegment), ' ')",
        "arm_label": "c_mktsegment", "product_id": "concat('prd-', CAST(c_nationkey AS STRING))", "product_role": "'test'",
        "dose": "CASE WHEN c_custkey % 6 = 0 THEN 'n/a' ELSE CAST(c_nationkey AS STRING) END", "dose_unit": "'mg'",
        "dosing_schedule": "' daily '", "planned_allocation_pct": "CAST(c_custkey % 100 AS STRING)"},
        "concat('study_arms_', CAST(c_custkey % 8 AS STRING), '.csv')"),
    "dim_product": ("part", {
        "product_id": "CASE WHEN p_partkey % 2 = 0 THEN concat('prd-', CAST(p_partkey % 300 AS STRING)) "
                      "ELSE concat(' PRD-', CAST(p_partkey % 300 AS STRING)) END",
        "sponsor_id": "CASE WHEN p_size % 5 = 0 THEN '-' ELSE concat('sp-', CAST(p_size % 5 AS STRING)) END",
        "product_code": "p_brand", "product_name": "concat(' ', p_name)", "active_ingredient": "p_type",
        "modality": "CASE WHEN p_size % 9 = 0 THEN '-' ELSE 'small' END", "mechanism_of_action": "'x'", "product_status": "'ACTIVE'"},
        "concat('products_', CAST(p_partkey % 4 AS STRING), '.csv')"),
    "ref_unit": ("part", {
        "lab_test_code": "concat(' t', CAST(p_size % 8 AS STRING))",
        "raw_unit": "CASE WHEN p_partkey % 37 = 0 THEN '-' WHEN p_partkey % 2 = 0 THEN lower(p_brand) ELSE concat(p_brand, ' ') END",
        "standard_unit": "'mg/dL '", "conversion_factor": "CASE WHEN p_partkey % 10 = 0 THEN 'one' ELSE CAST(p_size AS STRING) END"},
        "'unit_mapping.csv'"),
}
_FILE = "_source_file_name"


def _twin(name: str) -> str:
    """Keys and ids are normalised, raw mapping values and other columns trimmed; the row of the last file
    counts, then the greatest row."""
    source, cols, file = _DELIVERED[name]
    spec = s.MASTERS[name]

    def clean(c: str) -> str:
        if c.endswith("_id") or (c in spec.keys and not c.startswith("raw_")):
            return nk(c)
        return b2n(c) if c in spec.keys else f"trim({c})"

    def final(c: str) -> str:
        if c in spec.types:
            return f"TRY_CAST({c} AS {spec.types[c]}) AS {c}"
        return f"upper({c}) AS {c}" if c in spec.upper else c

    known = " AND ".join(f"{k} IS NOT NULL" for k in spec.keys)
    order = ", ".join(f"{c} DESC NULLS LAST" for c in (_FILE, *spec.columns))
    return f"""
    SELECT {', '.join(final(c) for c in spec.columns)}, {_FILE} FROM (
      SELECT *, row_number() OVER (PARTITION BY {', '.join(spec.keys)} ORDER BY {order}) AS place FROM (
        SELECT {', '.join(f'{clean(c)} AS {c}' for c in spec.columns)}, {_FILE} FROM (
          SELECT {', '.join(f'{e} AS {c}' for c, e in cols.items())}, {file} AS {_FILE} FROM {source})) WHERE {known})
    WHERE place = 1"""


def _dimension(name: str):
    def build(spark: SparkSession, sf: str) -> DataFrame:
        source, cols, file = _DELIVERED[name]
        raw = table(spark, sf, source).selectExpr(
            *[f"{e} AS {c}" for c, e in cols.items()], f"concat('landing/', {file}) AS _source_file", f"{file} AS {_FILE}",
            f"CAST('{AS_OF}' AS TIMESTAMP_NTZ) AS _source_file_modification_ts", f"CAST('{AS_OF}' AS TIMESTAMP_NTZ) AS _ingestion_ts",
            f"CAST('{AS_OF}' AS DATE) AS _ingestion_date")
        spec = s.MASTERS[name]
        return silver.dimension(raw, spec).select(*spec.columns, _FILE)

    return build


for _name in _DELIVERED:
    query(_twin(_name), name=_name)(_dimension(_name))
