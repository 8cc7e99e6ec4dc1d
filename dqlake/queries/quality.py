"""Queries over rules, routing and change history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dqlake.functions import n
from dqlake.operators import (
    END, START, assert_domain, current, dedupe_latest, dq_breakdown, dq_combinations, dq_impact,
    ROW_ID, arrived, quarantine, retest, route, scd1, scd2, scd2_check, scd2_from_snapshots, scd2_refresh, snapshot_step,
    stack, waiting_index, with_row_id,
)
from dqlake.operators import rules as r
from dqlake.plans import schemas as s, silver
from dqlake.plans.silver import ADVERSE_EVENT_COLUMNS, LAB_COLUMNS, SUBJECT_COLUMNS

from .feeds import table
from .oracle import TRACKED, with_tables
from .registry import ORACLES, query
from .silver_store import as_of, store


def _outcome() -> list[Column]:
    return [F.array_join("_dq_failures", ";").alias("why"), F.col("_is_valid").alias("valid")]


@query(with_tables(f"SELECT {', '.join(SUBJECT_COLUMNS)}, source_snapshot_date, why, why = '' AS valid "
                   "FROM subjects_v", "subjects_v"))
def validate_subjects(spark: SparkSession, sf: str) -> DataFrame:
    st = store(spark, sf)
    rows = silver.validate_subjects(st.feed("subjects"), st.references())
    return rows.select(*SUBJECT_COLUMNS, "source_snapshot_date", *_outcome())


_VISIT = ", ".join(s.FEEDS["visits"].columns)


@query(with_tables(f"SELECT {_VISIT}, why, why = '' AS valid FROM visits_v", "visits_v"))
def validate_visits(spark: SparkSession, sf: str) -> DataFrame:
    st = store(spark, sf)
    rows = silver.validate_visits(st.feed("visits"), st.references(), st.history())
    return rows.select(*s.FEEDS["visits"].columns, *_outcome())


@query(with_tables(f"SELECT {', '.join(ADVERSE_EVENT_COLUMNS)}, why, why = '' AS valid FROM events_v",
                   "events_v"))
def validate_adverse_events(spark: SparkSession, sf: str) -> DataFrame:
    st = store(spark, sf)
    rows = silver.validate_adverse_events(st.feed("adverse_events"), st.references(), st.history())
    return rows.select(*ADVERSE_EVENT_COLUMNS, *_outcome())


_LAB_SQL = ", ".join({
    "standardized_result_value": "sv AS standardized_result_value", "conversion_factor": "f AS conversion_factor",
    "standard_reference_low": "lo AS standard_reference_low",
    "standard_reference_high": "hi AS standard_reference_high",
    "abnormal_flag_discrepancy": "discrepancy AS abnormal_flag_discrepancy"}.get(c, c) for c in LAB_COLUMNS)


@query(with_tables(f"SELECT {_LAB_SQL}, why, why = '' AS valid FROM labs_v", "labs_v"))
def validate_labs(spark: SparkSession, sf: str) -> DataFrame:
    st = store(spark, sf)
    rows = silver.validate_labs(st.feed("labs"), st.references(), st.history(), st.valid("visits"))
    return rows.select(*LAB_COLUMNS, *_outcome())


def _over(cte: str, select: str) -> str:
    return with_tables(select.format(v=cte), cte)


_IMPACT = """
    SELECT count(*) AS total_rows, count(*) FILTER (WHERE k = 0) AS valid_rows,
      count(*) FILTER (WHERE k > 0) AS invalid_rows, count(*) FILTER (WHERE k > 1) AS multi_failure_rows,
      CAST(max(k) AS INT) AS max_failures_per_row,
      round(CAST(100.0 AS DOUBLE) * (count(*) FILTER (WHERE k = 0)) / count(*), 2) AS valid_pct,
      round(CAST(100.0 AS DOUBLE) * (count(*) FILTER (WHERE k > 0)) / count(*), 2) AS invalid_pct
    FROM (SELECT CASE WHEN why = '' THEN 0 ELSE length(why) - length(replace(why, ';', '')) + 1 END AS k
          FROM {v})"""


@query(_over("subjects_v", _IMPACT), name="dq_impact")
def subjects_impact(spark: SparkSession, sf: str) -> DataFrame:
    return dq_impact(store(spark, sf).subjects())


@query(_over("labs_v", _IMPACT))
def dq_impact_labs(spark: SparkSession, sf: str) -> DataFrame:
    return dq_impact(store(spark, sf).labs())


@query(_over("subjects_v", """
    SELECT failure_reason, count(*) AS failed_records FROM (
      SELECT unnest(string_split(why, ';')) AS failure_reason FROM {v} WHERE why <> '') GROUP BY 1"""),
    name="dq_breakdown")
def subjects_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return dq_breakdown(store(spark, sf).subjects())


@query(_over("labs_v", """
    SELECT why AS failure_combination, count(*) AS failed_records FROM {v} WHERE why <> '' GROUP BY 1"""),
    name="dq_combinations")
def labs_combinations(spark: SparkSession, sf: str) -> DataFrame:
    return dq_combinations(store(spark, sf).labs())


@query(with_tables("""
    SELECT visit_id, subject_id, visit_status, why AS dq_failure_reasons,
      CAST(length(why) - length(replace(why, ';', '')) + 1 AS INT) AS failure_count,
      DATE '2024-06-30' AS quarantined_on FROM visits_v WHERE why <> ''""", "visits_v"))
def quarantine_rows(spark: SparkSession, sf: str) -> DataFrame:
    return store(spark, sf).rejected("visits").select(
        "visit_id", "subject_id", "visit_status", "dq_failure_reasons",
        F.size("_dq_failures").alias("failure_count"),
        F.col("quarantined_at").cast("date").alias("quarantined_on"))


@query(with_tables("""
    SELECT ae_id, source_severity IS NOT NULL AND standard_severity IS NULL AS severity_mapping_warning,
      coalesce(resolution_date < onset_date, false) AS resolution_before_onset_warning,
      severity_rank IN (3, 4, 5) AND serious_flag = 'NO' AS high_severity_nonserious_warning,
      severity_rank = 1 AND serious_flag = 'YES' AS mild_serious_warning,
      outcome = 'FATAL' AND serious_flag = 'NO' AS fatal_nonserious_warning
    FROM events_v""", "events_v"))
def warning_flags(spark: SparkSession, sf: str) -> DataFrame:
    return store(spark, sf).adverse_events().select("ae_id", *silver.adverse_event_warnings())


@query(with_tables("""
    SELECT 'total_rows' AS rule, count(*) AS violations FROM hist
    UNION ALL SELECT 'invalid_subject_ids', count(*) FILTER (WHERE subject_id IS NULL OR trim(subject_id) = '') FROM hist
    UNION ALL SELECT 'invalid_age_rows', count(*) FILTER (WHERE age IS NULL OR age NOT BETWEEN 18 AND 100) FROM hist
    UNION ALL SELECT 'unmapped_sex_rows', count(*) FILTER (WHERE sex = 'UNMAPPED') FROM hist
    UNION ALL SELECT 'missing_screening_rows', count(*) FILTER (WHERE screening_date IS NULL) FROM hist
    UNION ALL SELECT 'invalid_status_rows', count(*) FILTER (WHERE subject_status IS NULL OR subject_status NOT IN (
      'SCREENING', 'ENROLLED', 'SCREEN_FAILED', 'DISCONTINUED', 'COMPLETED')) FROM hist
    UNION ALL SELECT 'arm_missing', count(*) FILTER (WHERE arm_code IS NULL) FROM hist""", "hist"), name="assert_domain")
def subjects_domain(spark: SparkSession, sf: str) -> DataFrame:
    """The five published checks of the history, and one that does find rows."""
    return assert_domain(store(spark, sf).history(), [
        r.Rule("invalid_subject_ids", F.col("subject_id").isNull() | (F.trim("subject_id") == "")),
        r.between("invalid_age_rows", "age", *s.AGE_RANGE), r.Rule("unmapped_sex_rows", F.col("sex") == "UNMAPPED"),
        r.missing("missing_screening_rows", "screening_date"), r.not_in("invalid_status_rows", "subject_status", s.SUBJECT_STATUSES),
        r.missing("arm_missing", "arm_code")])


# Subjects that are not known yet when the visits come; the visits of nobody else change.
_LATE_PARENT = "substr(subject_id, length(subject_id), 1) IN ('3', '7')"
_WAITS = {"unknown_silver_subject": "subject_id"}


@query(with_tables(f"""
    SELECT CASE WHEN NOT known THEN 'not waiting for them' WHEN why = '' THEN 'released' ELSE 'still rejected' END AS outcome,
      why AS dq_failure_reasons, count(*) AS row_count
    FROM (SELECT v.*, n.subject_id IS NOT NULL AND {_LATE_PARENT.replace("subject_id", "v.subject_id")} AS known
          FROM visits_v v LEFT JOIN now n ON v.subject_id = n.subject_id
          WHERE why <> '' OR {_LATE_PARENT.replace("subject_id", "v.subject_id")})
    WHERE why <> '' OR known GROUP BY 1, 2""", "visits_v", "now"), name="requarantine")
def late_subjects(spark: SparkSession, sf: str) -> DataFrame:
    """Visits that came before their subject are rejected, wait for it, and alone are tested when it comes."""
    st = store(spark, sf)
    raw, refs, history = with_row_id(st.feed("visits")), st.references(), st.history()
    early = history.where(f"NOT ({_LATE_PARENT})")
    first = st.kept("visits_before_subjects", lambda: silver.validate_visits(raw, refs, early))
    rejected = quarantine(first, as_of())
    ids = arrived(waiting_index(rejected, _WAITS), {"unknown_silver_subject": history.select("subject_id")})
    good, bad = route(retest(raw, ids, lambda rows: silver.validate_visits(rows, refs, history)), as_of())
    left = rejected.join(ids.select(ROW_ID).distinct(), ROW_ID, "left_anti").withColumn("outcome", F.lit("not waiting for them"))
    out = stack(good.select(F.lit("released").alias("outcome"), F.lit("").alias("dq_failure_reasons")),
                bad.select(F.lit("still rejected").alias("outcome"), "dq_failure_reasons"),
                left.select("outcome", "dq_failure_reasons"))
    return out.groupBy("outcome", "dq_failure_reasons").agg(n().alias("row_count"))


# --- change history

def _flat(history: DataFrame) -> DataFrame:
    return history.select(
        "subject_id", *TRACKED, "_source_file",
        F.col(f"{START}.source_snapshot_date").alias("start_date"),
        F.col(f"{START}._source_file_name").alias("start_file"),
        F.col(f"{END}.source_snapshot_date").alias("end_date"),
        F.col(f"{END}._source_file_name").alias("end_file"))


_FLAT_SQL = (f"SELECT subject_id, {', '.join(TRACKED)}, _source_file, start_date, start_file, end_date, "
             "end_file FROM ")


@query(with_tables(_FLAT_SQL + "hist", "hist"))
def scd2_history(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(silver.subject_history(store(spark, sf).valid("subjects")))


@query(with_tables(_FLAT_SQL + "hist", "hist"))
def scd2_history_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The same history with nearly every subject taken through the split for hot keys."""
    return _flat(silver.subject_history(store(spark, sf).valid("subjects"), hot_rows=2))


@query(with_tables(_FLAT_SQL + "now", "now"))
def scd2_current(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(current(store(spark, sf).history()))


@query(with_tables("""
    SELECT count(*) FILTER (WHERE c > 1) AS duplicate_current_keys,
      count(*) FILTER (WHERE c = 0) AS missing_current_keys, CAST(sum(b) AS BIGINT) AS invalid_intervals,
      CAST(sum(c) AS BIGINT) AS current_versions, CAST(sum(v - c) AS BIGINT) AS historical_versions,
      count(*) AS distinct_keys
    FROM (SELECT subject_id, count(*) AS v, count(*) FILTER (WHERE end_date IS NULL) AS c,
            count(*) FILTER (WHERE (end_date, end_file) <= (start_date, start_file)) AS b
          FROM hist GROUP BY 1)""", "hist"), name="scd2_check")
def subjects_scd2_check(spark: SparkSession, sf: str) -> DataFrame:
    return scd2_check(store(spark, sf).history(), ["subject_id"])


# Orders as a change feed per customer: the status is tracked, the price is not.
_ORDER_RUNS = """
    SELECT o_custkey, any_value(o_orderstatus) AS o_orderstatus,
      arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice,
      min(o_orderdate) AS first_date, min((o_orderdate, o_orderkey)) AS first_seq, run
    FROM (SELECT *, sum(opens) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS run
      FROM (SELECT *, CASE WHEN o_orderstatus IS DISTINCT FROM lag(o_orderstatus) OVER (
              PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) THEN 1 ELSE 0 END AS opens
            FROM orders)) GROUP BY o_custkey, run"""
_ORDER_HISTORY = f"""
    SELECT o_custkey, o_orderstatus, o_totalprice, first_date AS start_date,
      lead(first_date) OVER (PARTITION BY o_custkey ORDER BY first_seq) AS end_date
    FROM ({_ORDER_RUNS})"""


def _order_history(df: DataFrame) -> DataFrame:
    return df.select("o_custkey", "o_orderstatus", "o_totalprice",
                     F.col(f"{START}.o_orderdate").alias("start_date"),
                     F.col(f"{END}.o_orderdate").alias("end_date"))


_ORDER_FEED = dict(sequence=["o_orderdate", "o_orderkey"], track_except=["o_totalprice"],
                   drop=["o_orderpriority"])


@query(_ORDER_HISTORY)
def scd2_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _order_history(scd2(table(spark, sf, "orders"), ["o_custkey"], **_ORDER_FEED))


@query(_ORDER_HISTORY)
def scd2_orders_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Customers above six orders go through the split for hot keys."""
    return _order_history(scd2(table(spark, sf, "orders"), ["o_custkey"], hot_rows=6, **_ORDER_FEED))


@query(_ORDER_HISTORY, name="scd2_refresh")
def scd2_orders_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """History up to 1999, brought up to date by the later orders of every customer that has some."""
    orders = table(spark, sf, "orders")
    late = F.year("o_orderdate") >= 2000
    old = scd2(orders.where(~late), ["o_custkey"], **_ORDER_FEED)
    touched = orders.where(late).select("o_custkey").distinct()
    return _order_history(scd2_refresh(old, orders, touched, ["o_custkey"], **_ORDER_FEED))


@query("""
    SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders) WHERE rn = 1""")
def scd1_latest(spark: SparkSession, sf: str) -> DataFrame:
    return scd1(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")


@query("""
    WITH s AS (SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS snap,
                 arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus,
                 arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice
               FROM orders GROUP BY 1, 2),
    c AS (SELECT snap, lead(snap) OVER (ORDER BY snap) AS nxt FROM (SELECT DISTINCT snap FROM s)),
    m AS (SELECT s.*, nxt, CASE WHEN lag(nxt) OVER w = snap AND lag(o_orderstatus) OVER w = o_orderstatus
                           THEN 0 ELSE 1 END AS opens
          FROM s JOIN c USING (snap) WINDOW w AS (PARTITION BY o_custkey ORDER BY snap)),
    g AS (SELECT *, sum(opens) OVER (PARTITION BY o_custkey ORDER BY snap) AS run FROM m)
    SELECT o_custkey, any_value(o_orderstatus) AS o_orderstatus, arg_max(o_totalprice, snap) AS o_totalprice,
      min(snap) AS start_date, nullif(max(coalesce(nxt, DATE '9999-01-01')), DATE '9999-01-01') AS end_date
    FROM g GROUP BY o_custkey, run""")
def scd2_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Months as full snapshots: a customer without an order in a month was deleted there."""
    orders = table(spark, sf, "orders").withColumn("snap", F.trunc("o_orderdate", "month"))
    monthly = dedupe_latest(orders, ["o_custkey", "snap"], ["o_orderdate", "o_orderkey"])
    monthly = monthly.select("o_custkey", "snap", "o_orderstatus", "o_totalprice")
    return scd2_from_snapshots(monthly, ["o_custkey"], "snap", ["o_totalprice"]).select(
        "o_custkey", "o_orderstatus", "o_totalprice", F.col(START).alias("start_date"),
        F.col(END).alias("end_date"))


@query(ORACLES["scd2_snapshots"])
def scd2_snapshot_steps(spark: SparkSession, sf: str) -> DataFrame:
    """The last three months taken in one by one, each against the open versions only."""
    orders = table(spark, sf, "orders").withColumn("snap", F.trunc("o_orderdate", "month"))
    monthly = dedupe_latest(orders, ["o_custkey", "snap"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "snap", "o_orderstatus", "o_totalprice")
    days = [r[0] for r in monthly.select("snap").distinct().orderBy(F.desc("snap")).limit(3).collect()][::-1]
    history = scd2_from_snapshots(monthly.where(F.col("snap") < days[0]), ["o_custkey"], "snap", ["o_totalprice"])
    # the last of these earlier months is the newest delivery: versions it closed are closed
    open_, done = current(history), [history.where(F.col(END).isNotNull())]
    for day in days:
        open_, closed = snapshot_step(open_, monthly.where(F.col("snap") == day), ["o_custkey"], F.lit(day), ["o_totalprice"])
        done.append(closed)
    return stack(open_, *done).select("o_custkey", "o_orderstatus", "o_totalprice", F.col(START).alias("start_date"),
                                      F.col(END).alias("end_date"))
