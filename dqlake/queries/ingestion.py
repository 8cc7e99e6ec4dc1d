"""Queries over sources, sinks and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dqlake.operators import END, START
from dqlake.plans import silver
from dqlake.sources import (
    bindings, feed_inventory, header_drift, header_lines, ingest_feed, ingest_snapshot, landing_inventory, new_folder,
    observe_types, read_feed, read_lines, rescue, type_drift,
)
from dqlake.streaming import apply_changes, read_history, read_quarantine, read_reissued, read_valid, route_feed

from .feeds import AS_OF, table
from .oracle import with_tables
from .registry import query
from .quality import _ORDER_HISTORY
from .silver_store import as_of, store


@query(with_tables(f"""
    SELECT _source_file_name, count(*) AS row_count, count(DISTINCT subject_id) AS distinct_keys,
      DATE '{AS_OF}' AS first_day, DATE '{AS_OF}' AS last_day FROM f_visits GROUP BY 1""", "f_visits"),
    name="feed_inventory")
def visit_files(spark: SparkSession, sf: str) -> DataFrame:
    out = feed_inventory(store(spark, sf).feed("visits"), "subject_id")
    return out.select("_source_file_name", "row_count", "distinct_keys",
                      F.col("first_ingestion").cast("date").alias("first_day"),
                      F.col("last_ingestion").cast("date").alias("last_day"))


@query("""
    SELECT 'ctms' AS family, 'customers_' || c_mktsegment AS dataset, count(*) AS row_count, true AS has_files, true AS has_times
    FROM customer GROUP BY 2""", name="landing_inventory")
def delivered_segments(spark: SparkSession, sf: str) -> DataFrame:
    """The customer table delivered as a dataset a segment: what the inventory finds, beside the rows it stands for."""
    landing = new_folder(spark, "landing")
    rows = table(spark, sf, "customer")
    for (segment,) in rows.select("c_mktsegment").distinct().collect():  # a handful of segments
        rows.where(F.col("c_mktsegment") == segment).write.option("header", True).csv(f"{landing}/ctms/customers_{segment}")
    found = landing_inventory(spark, landing).where(F.size(F.filter("file_names", lambda f: f.endswith(".csv"))) > 0)
    lines = spark.read.option("header", True).option("recursiveFileLookup", True).csv(landing)
    lines = lines.groupBy(F.regexp_extract(F.col("_metadata.file_path"), "/([^/]+)/[^/]+$", 1).alias("dataset")).count()
    lines = lines.withColumn("dataset", F.url_decode("dataset"))
    return found.join(lines, "dataset").select("family", "dataset", F.col("count").alias("row_count"), (
        (F.col("file_count") > 0) & (F.col("total_bytes") > 0)).alias("has_files"), (
        F.col("first_modified") <= F.col("last_modified")).alias("has_times"))


_LAB_NUMBERS = ("result_value", "reference_low", "reference_high")


@query(with_tables(f"""
    SELECT lab_result_id, {", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in _LAB_NUMBERS)},
      nullif(concat('{{', concat_ws(',', {", ".join(f"""CASE WHEN {c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL
        THEN concat('"{c}":"', {c}, '"') END""" for c in _LAB_NUMBERS)}), '}}'), '{{}}') AS _rescued_data
    FROM f_labs""", "f_labs"))
def rescue_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = store(spark, sf).feed("labs").select("lab_result_id", *_LAB_NUMBERS)
    return rescue(rows, dict.fromkeys(_LAB_NUMBERS, "double"))


_CUSTOMER = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
_CUSTOMER_TYPES = {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double"}

# Three kinds of delivery of the customer table, by key: as the table is; in another order, quoted; with an
# unknown column, surplus fields and lines that break off. The expressions are SQL of both engines.
_KEY, _BALANCE = "CAST(c_custkey AS STRING)", "CASE WHEN c_custkey % 97 = 0 THEN 'n/a' ELSE CAST(c_acctbal AS STRING) END"
_QUOTED = """concat(c_name, ', "', c_mktsegment, '"')"""
_OPEN = f"""concat('"', c_name, ',', {_KEY}, ',L', CAST(c_nationkey AS STRING))"""
_PLAIN = (f"concat(c_name, ',', {_KEY}, ',L', CAST(c_nationkey AS STRING), ',', CAST(c_nationkey AS STRING), ',', {_BALANCE}, "
          "',', c_mktsegment, CASE WHEN c_custkey % 101 = 0 THEN ',a b,' ELSE '' END)")


def _deliver(spark: SparkSession, sf: str, kind: int, landing: str) -> None:
    """One kind of delivery of the customer table as CSV files."""
    rows = table(spark, sf, "customer").where(F.col("c_custkey") % 3 == kind)
    if kind == 0:
        rows.selectExpr(f"{_KEY} AS c_custkey", "c_name", "c_nationkey", f"{_BALANCE} AS C_AcctBal", "c_mktsegment").write.mode(
            "append").option("header", True).csv(landing)
    elif kind == 1:
        rows.selectExpr("c_mktsegment", f"{_BALANCE} AS c_acctbal", "c_nationkey", f"{_QUOTED} AS c_name", f"{_KEY} AS c_custkey").write.mode(
            "append").option("header", True).option("quoteAll", True).option("escape", '"').csv(landing)
    else:
        lines = rows.selectExpr(f"CASE WHEN c_custkey % 103 = 0 THEN {_OPEN} ELSE {_PLAIN} END AS "
                                "`c_name,c_custkey,loyalty,c_nationkey,c_acctbal,c_mktsegment`")
        # lines as they are: no separator and no quote that could occur in them
        lines.write.mode("append").option("header", True).option("sep", "\u0001").option("quote", "\u0002").option(
            "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(landing)


def _delivered_sql(typed: bool) -> str:
    """Without the types a balance is text and nothing but lines and surplus is rescued."""
    def cast(x: str, kind: str) -> str:
        return f"TRY_CAST({x} AS {kind})" if typed else f"CAST({x} AS STRING)"

    lost = f"""CASE WHEN {str(typed).lower()} AND c_custkey % 97 = 0 THEN '"c_acctbal":"n/a"' END"""
    return f"""
    SELECT {cast("key", "BIGINT")} AS c_custkey, name AS c_name, {cast("nation", "INT")} AS c_nationkey,
      {cast("balance", "DOUBLE")} AS c_acctbal, segment AS c_mktsegment, true AS has_file,
      DATE '{AS_OF}' AS _ingestion_date, _rescued_data
    FROM (
      SELECT {_KEY} AS key, CASE WHEN c_custkey % 3 = 1 THEN {_QUOTED} ELSE c_name END AS name, CAST(c_nationkey AS STRING) AS nation,
        {_BALANCE} AS balance, c_mktsegment AS segment,
        CASE WHEN c_custkey % 3 = 2 THEN concat('{{', concat_ws(',', concat('"loyalty":"L', CAST(c_nationkey AS STRING), '"'),
               CASE WHEN c_custkey % 101 = 0 THEN '"#7":"a b","#8":""' END, {lost}), '}}')
             WHEN {lost} IS NOT NULL THEN concat('{{', {lost}, '}}') END AS _rescued_data
      FROM customer WHERE c_custkey % 3 <> 2 OR c_custkey % 103 <> 0
      UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, concat('{{"_line":"', replace({_OPEN}, '"', chr(92) || '"'), '"}}')
      FROM customer WHERE c_custkey % 3 = 2 AND c_custkey % 103 = 0)"""


def _delivered(df: DataFrame) -> DataFrame:
    lineage = (F.col("_source_file_name").endswith(".csv") & F.col("_source_file").contains("/ctms/")
               & F.col("_source_file_modification_ts").isNotNull() & F.col("_ingestion_ts").isNotNull())
    return df.select(*_CUSTOMER, lineage.alias("has_file"), "_ingestion_date", "_rescued_data")


def _landing(spark: SparkSession) -> str:
    return f"{new_folder(spark, 'landing')}/ctms/customers"


@query(_delivered_sql(False), name="ingest_snapshot")
def customer_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Files of three layouts in one folder, all columns as text."""
    path = _landing(spark)
    for kind in range(3):
        _deliver(spark, sf, kind, path)
    return _delivered(ingest_snapshot(spark, path, _CUSTOMER, new_folder(spark, "bronze"), as_of()))


@query(_delivered_sql(True), name="ingest_feed")
def customer_feed(spark: SparkSession, sf: str) -> DataFrame:
    """A run after each delivery and one without: every file is taken once, by its own header."""
    path, sink, checkpoint = _landing(spark), new_folder(spark, "bronze"), new_folder(spark, "offsets")
    for kind in (0, 1, 2, None):
        if kind is not None:
            _deliver(spark, sf, kind, path)
        ingest_feed(spark, path, _CUSTOMER, sink, checkpoint, as_of(), _CUSTOMER_TYPES)
    return _delivered(read_feed(spark, sink, _CUSTOMER, _CUSTOMER_TYPES))


@query("""
    SELECT '' AS missing_columns, CASE WHEN c_custkey % 3 = 2 THEN 'loyalty' ELSE '' END AS unknown_columns, true AS reordered,
      count(*) AS row_count FROM customer WHERE c_custkey % 3 > 0 GROUP BY 1, 2""", name="header_drift")
def customer_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Rows under a header other than the table's columns, by what is different."""
    path = _landing(spark)
    for kind in range(3):
        _deliver(spark, sf, kind, path)
    drift = header_drift(bindings(header_lines(spark, path), _CUSTOMER), _CUSTOMER)
    per_file = read_lines(spark.read, path).groupBy(F.col("_metadata.file_path").alias("_source_file")).count()
    return drift.join(per_file, "_source_file").groupBy("missing_columns", "unknown_columns", "reordered").agg(
        F.sum("count").alias("row_count"))


_LAB_TYPED = ("result_value", "reference_low", "reference_high", "collection_date", "visit_id")
_MISFITS = {
    "boolean": "NOT regexp_full_match({v}, '(?i)true|false')",
    "int": "NOT (regexp_full_match({v}, '[+-]?[0-9]+') AND TRY_CAST({v} AS INT) IS NOT NULL)",
    "bigint": "NOT (regexp_full_match({v}, '[+-]?[0-9]+') AND TRY_CAST({v} AS BIGINT) IS NOT NULL)",
    "double": r"NOT regexp_full_match({v}, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?')",
    "date": "NOT (regexp_full_match({v}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND TRY_CAST({v} AS DATE) IS NOT NULL)",
}
_FIRST = ("CASE WHEN coalesce(sum(n) {o}, 0) = 0 THEN 'void' "
          + " ".join(f"WHEN sum(no_{k}) {{o}} = 0 THEN '{k}'" for k in _MISFITS) + " ELSE 'string' END")
_PER_FILE = " UNION ALL ".join(
    f"SELECT _source_file_name AS file, '{c}' AS column_name, count({c}) AS n, "
    + ", ".join(f"count(*) FILTER (WHERE {m.format(v=c)}) AS no_{k}" for k, m in _MISFITS.items())
    + " FROM f_labs GROUP BY 1" for c in _LAB_TYPED)


@query(with_tables(f"""
    SELECT file AS _source_file_name, column_name, n AS value_count, own AS delivery_type, past AS known_type, upto AS merged_type,
      CAST(CASE past {" ".join(f"WHEN '{k}' THEN no_{k}" for k in _MISFITS)} ELSE 0 END AS BIGINT) AS contradictions
    FROM (SELECT *, {_FIRST.format(o="OVER (PARTITION BY column_name, file)")} AS own,
            {_FIRST.format(o="OVER (PARTITION BY column_name ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")} AS past,
            {_FIRST.format(o="OVER (PARTITION BY column_name ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")} AS upto
          FROM ({_PER_FILE}))""", "f_labs"), name="type_drift")
def lab_type_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Types of the lab columns, delivery after delivery: numbers meet text, dates meet other formats."""
    seen = observe_types(store(spark, sf).feed("labs"), _LAB_TYPED, "_source_file_name")
    return type_drift(seen, "_source_file_name")


@query(with_tables("""
    SELECT subject_id, visit_id, why = '' AS valid, why FROM visits_v""", "visits_v"))
def feed_route_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Visits as a file stream, joined to the static trusted tables and routed."""
    st = store(spark, sf)
    raw, sink = new_folder(spark, "raw"), new_folder(spark, "routed")
    st.feed("visits").write.parquet(raw)
    stream = spark.readStream.schema(spark.read.parquet(raw).schema).parquet(raw)
    route_feed(stream, lambda b: silver.validate_visits(b, st.references(), st.history()), sink,
               new_folder(spark, "offsets"))
    good = read_valid(spark, sink).select("subject_id", "visit_id", F.lit(True).alias("valid"),
                                          F.lit("").alias("why"))
    bad = read_quarantine(spark, sink, as_of()).select(
        "subject_id", "visit_id", F.lit(False).alias("valid"), F.col("dq_failure_reasons").alias("why"))
    return good.unionByName(bad)


@query(_ORDER_HISTORY)
def scd2_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Orders delivered newest year first, one batch per year: the history must not care."""
    orders = table(spark, sf, "orders")
    raw, log = new_folder(spark, "raw"), new_folder(spark, "changes")
    history, checkpoint = new_folder(spark, "history"), new_folder(spark, "offsets")
    years = orders.withColumn("delivered", F.year("o_orderdate"))
    late = F.col("delivered") >= 1999
    for part in (years.where(late), years.where(~late)):
        part.drop("delivered").write.mode("append").parquet(raw)
        stream = spark.readStream.schema(orders.schema).parquet(raw)
        apply_changes(spark, stream, ["o_custkey"], ["o_orderdate", "o_orderkey"], log, history,
                      checkpoint, buckets=8, track_except=["o_totalprice"], drop=["o_orderpriority"],
                      hot_rows=None)
    return read_history(spark, history).select(
        "o_custkey", "o_orderstatus", "o_totalprice",
        F.col(f"{START}.o_orderdate").alias("start_date"), F.col(f"{END}.o_orderdate").alias("end_date"))


_HALF = "_source_file_name < 'adverse_events_20240116.csv'"


@query(with_tables(f"""
    SELECT CAST(b AS BIGINT) AS batch, ae_id, count(*) AS row_count, bool_or(before) AS in_target
    FROM (SELECT ae_id, CASE WHEN {_HALF} THEN 0 ELSE 1 END AS b,
            NOT ({_HALF}) AND ae_id IN (SELECT ae_id FROM events_v WHERE why = '' AND ae_id IS NOT NULL AND {_HALF}) AS before
          FROM events_v WHERE why = '' AND ae_id IS NOT NULL) GROUP BY 1, 2 HAVING count(*) > 1 OR bool_or(before)""",
    "events_v"), name="reissued_keys_stream")
def reissued_in_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Adverse events in two deliveries: ids accepted in the first come again in the second."""
    st = store(spark, sf)
    raw, sink, checkpoint = new_folder(spark, "raw"), new_folder(spark, "routed"), new_folder(spark, "offsets")
    events = st.feed("adverse_events")
    for early in (_HALF, f"NOT ({_HALF})"):
        events.where(early).write.mode("append").parquet(raw)
        # every file of the delivery in one batch
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 100_000).parquet(raw)
        route_feed(stream, lambda b: silver.validate_adverse_events(b, st.references(), st.history()), sink, checkpoint,
                   key="ae_id")
    return read_reissued(spark, sink).select(F.col("batch_id").cast("long").alias("batch"), "ae_id", "row_count", "in_target")
