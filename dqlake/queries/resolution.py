"""Queries over deduplication, reference resolution and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dqlake.functions import n, n_if, normalize_key, total, variants
from dqlake.operators import (
    dedupe_latest, first_by, inherit, key_set, lookup, orphan_counts, orphans,
    profile_top, rank_within, reference, reference_conflicts, reissued_keys, rollup, top,
)
from dqlake.plans import silver

from .feeds import table
from .oracle import nk, with_tables
from .registry import query
from .silver_store import store

_LINE_COLUMNS = ("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount "
                 "l_tax l_returnflag l_linestatus l_shipdate").split()


def _latest_sql(keys: str, order: list[str]) -> str:
    by = ", ".join(f"{c} DESC NULLS LAST" for c in [*order, *[c for c in _LINE_COLUMNS if c not in order]])
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
            f"ORDER BY {by}) AS rn FROM lineitem) WHERE rn = 1")


@query(_latest_sql("l_orderkey, l_linenumber", ["l_shipdate"]), name="dedupe_latest")
def latest_lines(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe_latest(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query(_latest_sql("l_orderkey", []), name="first_by")
def one_line_per_order(spark: SparkSession, sf: str) -> DataFrame:
    return first_by(table(spark, sf, "lineitem"), ["l_orderkey"])


@query("""
    SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice, CAST(rn AS INT) AS place FROM (
      SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey,
        l_linenumber, l_partkey) AS rn FROM lineitem) WHERE rn <= 3""", name="rank_within")
def top_lines_per_supplier(spark: SparkSession, sf: str) -> DataFrame:
    ranked = rank_within(
        table(spark, sf, "lineitem"), ["l_suppkey"],
        [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey")],
        3, "place")
    return ranked.select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice", "place")


@query("""
    SELECT upper(trim(p_brand)) AS brand, max(p_type) AS p_type, max(p_size) AS p_size
    FROM part GROUP BY 1""")
def reference_collapse(spark: SparkSession, sf: str) -> DataFrame:
    return reference(table(spark, sf, "part"), {"brand": normalize_key("p_brand")},
                     {"p_type": F.col("p_type"), "p_size": F.col("p_size")})


@query("SELECT DISTINCT upper(trim(p_brand)) AS brand, upper(trim(p_type)) AS kind FROM part",
       name="key_set")
def part_keys(spark: SparkSession, sf: str) -> DataFrame:
    return key_set(table(spark, sf, "part"),
                   {"brand": normalize_key("p_brand"), "kind": normalize_key("p_type")})


@query("""
    SELECT upper(trim(p_name)) AS name, count(DISTINCT (p_brand, p_type)) AS value_count
    FROM part GROUP BY 1 HAVING count(DISTINCT (p_brand, p_type)) > 1""", name="reference_conflicts")
def part_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return reference_conflicts(table(spark, sf, "part"), {"name": normalize_key("p_name")},
                               [F.col("p_brand"), F.col("p_type")])


@query(with_tables(f"""
    SELECT t.source_severity, s.v AS standard_severity, s.rk AS severity_rank, count(*) AS row_count
    FROM (SELECT severity AS source_severity, {nk('severity')} AS k FROM f_adverse_events) t
    LEFT JOIN r_sev s ON t.k = s.k GROUP BY 1, 2, 3""", "f_adverse_events", "r_sev"), name="lookup")
def lookup_severity(spark: SparkSession, sf: str) -> DataFrame:
    st = store(spark, sf)
    rows = st.feed("adverse_events").select(F.col("severity").alias("source_severity"),
                                            normalize_key("severity").alias("_key"))
    found = lookup(rows, silver.severity_ref(st.references()), {"_key": "_severity_key"})
    return (found.groupBy("source_severity", F.col("_standard_severity").alias("standard_severity"),
                          F.col("_severity_rank").alias("severity_rank"))
            .agg(n().alias("row_count")))


@query(with_tables(f"""
    SELECT t.t AS test, t.u AS unit, u.unit AS standard_unit, u.f AS factor, count(*) AS row_count
    FROM (SELECT {nk('lab_test_code')} AS t, {nk('result_unit')} AS u FROM f_labs) t
    LEFT JOIN r_unit u ON t.t = u.t AND t.u = u.u GROUP BY 1, 2, 3, 4""", "f_labs", "r_unit"))
def lookup_composite(spark: SparkSession, sf: str) -> DataFrame:
    st = store(spark, sf)
    rows = st.feed("labs").select(normalize_key("lab_test_code").alias("test"),
                                  normalize_key("result_unit").alias("unit"))
    found = lookup(rows, silver.unit_ref(st.references()), {"test": "_unit_test", "unit": "_unit_key"})
    return (found.groupBy("test", "unit", F.col("_unit_standard").alias("standard_unit"),
                          F.col("_factor").alias("factor")).agg(n().alias("row_count")))


@query(with_tables(f"""
    SELECT l.visit_id, l.lab_test_code, v.subject_id AS visit_subject, v.visit_id IS NOT NULL AS found,
      count(*) AS row_count
    FROM (SELECT {nk('visit_id')} AS visit_id, {nk('lab_test_code')} AS lab_test_code FROM f_labs) l
    LEFT JOIN r_visit v ON l.visit_id = v.visit_id GROUP BY 1, 2, 3, 4""", "f_labs", "r_visit"))
def lookup_large(spark: SparkSession, sf: str) -> DataFrame:
    st = store(spark, sf)
    rows = st.feed("labs").select(normalize_key("visit_id").alias("visit_id"),
                                  normalize_key("lab_test_code").alias("lab_test_code"))
    found = lookup(rows, silver.trusted_visits(st.valid("visits")), {"visit_id": "_visit_key"}, split_nulls=True)
    return (found.groupBy("visit_id", "lab_test_code", F.col("_visit_subject").alias("visit_subject"),
                          F.col("_visit_key").isNotNull().alias("found"))
            .agg(n().alias("row_count")))


_CITY = "CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE concat('City ', CAST(n_nationkey % 4 AS STRING)) END"
_LAND = "CASE WHEN n_nationkey % 2 = 0 THEN '-' ELSE lower(n_name) END"


@query(f"""
    SELECT s_suppkey, city, n_name AS country, coalesce(g.region, c.region, 'UNMAPPED') AS region
    FROM (SELECT s_suppkey, concat('city ', CAST(s_suppkey % 4 AS STRING), ' ') AS city, n_name
          FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey) s
    LEFT JOIN (SELECT {_CITY} AS gc, n_name AS gn, concat('city region ', r_name) AS region
               FROM nation JOIN region ON n_regionkey = r_regionkey) g
      ON upper(trim(s.city)) = upper(gc) AND s.n_name = gn
    LEFT JOIN (SELECT {_LAND} AS cn, r_name AS region
               FROM nation JOIN region ON n_regionkey = r_regionkey) c ON s.n_name = upper(cn)""",
    name="lookup_fallback")
def supplier_region(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    supplier = table(spark, sf, "supplier")
    places = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    geography = places.selectExpr(f"{_CITY} AS city", "n_name AS country",
                                  "concat('city region ', r_name) AS region")
    countries = places.selectExpr(f"{_LAND} AS country", "r_name AS region")
    sites = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"], "left").selectExpr(
        "s_suppkey", "concat('city ', CAST(s_suppkey % 4 AS STRING), ' ') AS city", "n_name AS country")
    return silver.with_region(sites, geography, countries)


@query(with_tables("""
    SELECT l.study_id, n.site_id, count(*) AS row_count FROM labs_v l
    LEFT JOIN now n ON l.subject_id = n.subject_id GROUP BY 1, 2""", "labs_v", "now"), name="inherit")
def inherit_site(spark: SparkSession, sf: str) -> DataFrame:
    st = store(spark, sf)
    current = st.history().where("__END_AT is null")
    rows = inherit(st.labs().select("study_id", "subject_id"), current, "subject_id", ["site_id"])
    return rows.groupBy("study_id", "site_id").agg(n().alias("row_count"))


@query(with_tables(f"""
    SELECT {nk('visit_id')} AS visit_id, count(*) AS row_count FROM f_labs
    WHERE {nk('visit_id')} IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM f_visits v WHERE {nk('v.visit_id')} = {nk('f_labs.visit_id')})
    GROUP BY 1""", "f_labs", "f_visits"), name="orphans")
def lab_orphans(spark: SparkSession, sf: str) -> DataFrame:
    labs = store(spark, sf).feed("labs").select(normalize_key("visit_id").alias("visit_id"))
    visits = store(spark, sf).feed("visits").select(normalize_key("visit_id").alias("visit_id"))
    return orphans(labs, visits, {"visit_id": "visit_id"}).groupBy("visit_id").agg(n().alias("row_count"))


def _orphan_sql(name: str, child: str, ck: str, parent: str, pk: str) -> str:
    return (f"SELECT '{name}' AS relationship, count(*) AS orphan_rows FROM {child} c WHERE {ck} IS NOT NULL "
            f"AND {ck} NOT IN (SELECT {pk} FROM {parent} WHERE {pk} IS NOT NULL)")


@query(with_tables(" UNION ALL ".join([
    _orphan_sql("CUSTOMER_TO_NATION", "customer", "c_nationkey", "nation", "n_nationkey"),
    _orphan_sql("EVENT_TO_CUSTOMER", "events", "user_id", "customer", "c_custkey"),
    _orphan_sql("LINE_TO_ORDER", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    _orphan_sql("LABEL_TO_DOCUMENT", "labels", "doc_id", "documents", "doc_id"),
    _orphan_sql("VISIT_TO_SUBJECT", f"(SELECT {nk('subject_id')} AS s FROM f_visits)", "s",
                "hist", "subject_id"),
]), "f_visits", "hist"), name="orphan_counts")
def relationship_orphans(spark: SparkSession, sf: str) -> DataFrame:
    def t(name: str) -> DataFrame:
        return table(spark, sf, name)

    st = store(spark, sf)
    visits = st.feed("visits").select(normalize_key("subject_id").alias("s"))
    return orphan_counts({
        "CUSTOMER_TO_NATION": (t("customer"), t("nation"), {"c_nationkey": "n_nationkey"}),
        "EVENT_TO_CUSTOMER": (t("events"), t("customer"), {"user_id": "c_custkey"}),
        "LINE_TO_ORDER": (t("lineitem"), t("orders"), {"l_orderkey": "o_orderkey"}),
        "LABEL_TO_DOCUMENT": (t("labels"), t("documents"), {"doc_id": "doc_id"}),
        "VISIT_TO_SUBJECT": (visits, st.history(), {"s": "subject_id"}),
    })


@query(with_tables("""
    SELECT subject_id, count(*) AS visit_count, min(visit_date) AS first_visit_date,
      max(visit_date) AS last_visit_date,
      count(*) FILTER (WHERE visit_status = 'COMPLETED') AS completed_visits,
      count(*) FILTER (WHERE visit_status = 'MISSED') AS missed_visits
    FROM visits_ok WHERE subject_id IN (SELECT subject_id FROM visits_ok GROUP BY 1
      ORDER BY count(*) DESC, subject_id LIMIT 3) GROUP BY 1""", "visits_ok"), name="profile_top")
def busiest_subjects(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("visit_status")
    return profile_top(store(spark, sf).valid("visits"), "subject_id", 3, {
        "visit_count": n(), "first_visit_date": F.min("visit_date"),
        "last_visit_date": F.max("visit_date"), "completed_visits": n_if(status == "COMPLETED"),
        "missed_visits": n_if(status == "MISSED")})


@query("""
    SELECT p_brand, count(*) AS parts, CAST(sum(p_size) AS BIGINT) AS total_size FROM part GROUP BY 1
    ORDER BY total_size DESC, p_brand LIMIT 5""", name="top")
def largest_brands(spark: SparkSession, sf: str) -> DataFrame:
    brands = rollup(table(spark, sf, "part"), ["p_brand"], {"parts": n(), "total_size": total("p_size")})
    return top(brands, [F.desc("total_size"), F.asc("p_brand")], 5)


@query("""
    SELECT l_suppkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags
    FROM lineitem GROUP BY 1""", name="variants")
def return_flag_variants(spark: SparkSession, sf: str) -> DataFrame:
    return rollup(table(spark, sf, "lineitem"), ["l_suppkey"],
                  {"flags": F.concat_ws(",", variants("l_returnflag"))})


_LATE = "_source_file_name >= 'adverse_events_20240116.csv'"


@query(with_tables(f"""
    SELECT ae_id, count(*) AS row_count, bool_or(seen) AS in_target
    FROM (SELECT {nk('ae_id')} AS ae_id, {nk('ae_id')} IN (
            SELECT {nk('ae_id')} FROM f_adverse_events WHERE NOT {_LATE} AND {nk('ae_id')} IS NOT NULL) AS seen
          FROM f_adverse_events WHERE {_LATE} AND {nk('ae_id')} IS NOT NULL)
    GROUP BY 1 HAVING count(*) > 1 OR bool_or(seen)""", "f_adverse_events"), name="reissued_keys")
def reissued_events(spark: SparkSession, sf: str) -> DataFrame:
    """The deliveries from mid January on against those before."""
    rows = store(spark, sf).feed("adverse_events").select(normalize_key("ae_id").alias("ae_id"),
                                                    "_source_file_name")
    late = F.col("_source_file_name") >= "adverse_events_20240116.csv"
    return reissued_keys(rows.where(late), rows.where(~late), "ae_id")
