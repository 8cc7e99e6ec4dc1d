"""File sources: feeds, snapshots, lineage, rescued values, landing inventory."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from dqlake.functions import n, n_distinct, variants

from .delimited import FILE, RESCUED, bind, bindings, header_lines, read_lines
from .types import merged_types, observe_types

BATCH = "batch_id"
# New files a batch takes at most: their names and headers pass the driver.
MAX_FILES = 1000


def text_schema(columns: Sequence[str]) -> StructType:
    """All-text schema: raw layers keep every value as delivered."""
    return StructType([StructField(c, StringType()) for c in columns])


def with_lineage(df: DataFrame, as_of: Column) -> DataFrame:
    """File lineage and ingestion time. Works on batch and streaming file reads;
    must be applied before anything that hides the file metadata."""
    at = as_of.cast("timestamp")
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_name").alias("_source_file_name"),
        F.col("_metadata.file_modification_time").alias("_source_file_modification_ts"),
        at.alias("_ingestion_ts"),
        at.cast("date").alias("_ingestion_date"),
    )


def _laid_out(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Data columns, lineage, rescue column."""
    lineage = [c for c in rows.columns if c not in columns and c != RESCUED]
    return rows.select(*columns, *lineage, RESCUED)


def read_snapshot(spark: SparkSession, path: str, columns: Sequence[str], as_of: Column) -> DataFrame:
    """All CSV files of a folder as text columns, with lineage; each file is bound by its own header,
    and what has no column is in ``_rescued_data`` (see ``bind``)."""
    lines = with_lineage(read_lines(spark.read, path), as_of)
    return _laid_out(bind(lines, bindings(header_lines(spark, path), columns), columns), columns)


def ingest_feed(
    spark: SparkSession, path: str, columns: Sequence[str], sink: str, checkpoint: str, as_of: Column,
    types: Mapping[str, str] | None = None, observe: str | None = None, max_files: int = MAX_FILES,
) -> None:
    """Append the files not yet seen to ``sink``, typing the ``types`` columns.

    The checkpoint names each file once, and a batch writes under its own number with overwrite: a
    batch replayed after a failure replaces itself. ``observe`` is the folder in which the types seen
    in the untyped columns are kept, batch by batch, see ``known_types``.
    """
    lines = with_lineage(read_lines(spark.readStream.option("maxFilesPerTrigger", max_files), path), as_of)
    free = [c for c in columns if c not in (types or {})]

    def each(batch: DataFrame, batch_id: int) -> None:
        files = [r[0] for r in batch.select(FILE).distinct().collect()]  # at most max_files
        if not files:
            return
        bound = bindings(header_lines(spark, path, files), columns)
        own = f"{sink}/{BATCH}={batch_id}"
        _laid_out(rescue(bind(batch, bound, columns), types or {}), columns).write.mode("overwrite").parquet(own)
        if observe and free:
            seen = observe_types(spark.read.parquet(own), free, "_source_file_name")
            seen.write.mode("overwrite").parquet(f"{observe}/{BATCH}={batch_id}")

    query = (
        lines.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def read_feed(spark: SparkSession, sink: str, columns: Sequence[str], types: Mapping[str, str] | None = None) -> DataFrame:
    """The table a feed was ingested to; without rows where nothing was delivered yet."""
    try:
        return spark.read.parquet(sink).drop(BATCH)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    fields = [f"`{c}` {(types or {}).get(c, 'string')}" for c in columns]
    lineage = [f"{FILE} string", "_source_file_name string", "_source_file_modification_ts timestamp",
               "_ingestion_ts timestamp", "_ingestion_date date", f"{RESCUED} string"]
    return spark.createDataFrame([], ", ".join([*fields, *lineage]))


def known_types(spark: SparkSession, observe: str) -> dict[str, str]:
    """The narrowest types that hold every value delivered so far, one entry per column."""
    merged = merged_types(spark.read.parquet(observe))
    return {r["column_name"]: "string" if r["type"] == "void" else r["type"] for r in merged.collect()}


def typed_feed(spark: SparkSession, sink: str, observe: str) -> DataFrame:
    """An ingested table with its text columns in the types of ``known_types``. As types only widen,
    every value fits; a value delivered while this runs is rescued."""
    types = {c: t for c, t in known_types(spark, observe).items() if t != "string"}
    return rescue(spark.read.parquet(sink).drop(BATCH), types)


def ingest_snapshot(
    spark: SparkSession, path: str, columns: Sequence[str], sink: str, as_of: Column
) -> DataFrame:
    """Full refresh of a master or reference folder; returns the written table."""
    read_snapshot(spark, path, columns, as_of).write.mode("overwrite").parquet(sink)
    return spark.read.parquet(sink)


def rescued_values(types: Mapping[str, str]) -> Column:
    """JSON of the text values that do not fit their type; NULL when all do."""
    lost = {c: F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.col(c)) for c, t in types.items()}
    if not lost:
        return F.lit(None).cast("string")
    as_json = F.to_json(F.struct(*[raw.alias(c) for c, raw in lost.items()]))
    return F.when(F.coalesce(*lost.values()).isNotNull(), as_json)


def rescue(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Type text columns; values that do not fit go to ``_rescued_data`` as JSON.

    No value is lost: what the typed column cannot hold is in the rescue
    column, after what it held before. Other columns pass unchanged.
    """
    lost = rescued_values(types)
    if RESCUED in df.columns:
        had = F.col(RESCUED)
        both = F.concat(F.substr(had, F.lit(1), F.length(had) - 1), F.lit(","), F.substr(lost, F.lit(2)))
        lost = F.coalesce(both, had, lost)
    return df.withColumns({RESCUED: lost, **{c: F.col(c).try_cast(t) for c, t in types.items()}})


def feed_inventory(df: DataFrame, key: str, file: str = "_source_file_name",
                   at: str = "_ingestion_ts") -> DataFrame:
    """Rows, distinct keys and first/last ingestion per delivered file."""
    return df.groupBy(file).agg(
        n().alias("row_count"), n_distinct(key).alias("distinct_keys"),
        F.min(at).alias("first_ingestion"), F.max(at).alias("last_ingestion"),
    )


def landing_inventory(spark: SparkSession, root: str) -> DataFrame:
    """File counts, sizes and modification times per family and dataset.

    Only file metadata is read. Below ``root`` the first folder is the family
    and a folder below that the dataset; a file right in a family is a dataset
    by itself, and one right under ``root`` belongs to the family ``.``. The
    name list grows with the deliveries of one dataset, not with their rows.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        .select("path", "modificationTime", "length")
    )
    scheme = r"^[a-z0-9]+:/+"
    depth = len([p for p in re.sub(scheme, "", root).split("/") if p])
    inner = F.filter(F.split(F.regexp_replace("path", scheme, ""), "/"), lambda p: p != "")
    inner = F.slice(inner, depth + 1, F.size(inner) - depth)
    parts = files.withColumn("__p", inner)
    depth_left = F.size("__p")
    name = F.element_at("__p", -1)
    return (
        parts.select(
            F.when(depth_left > 1, F.element_at("__p", 1)).otherwise(".").alias("family"),
            F.when(depth_left > 2, F.element_at("__p", -2))
            .otherwise(F.regexp_extract(name, r"^([^.]+)", 1)).alias("dataset"),
            name.alias("file_name"), "length", "modificationTime",
        )
        .groupBy("family", "dataset")
        .agg(
            n().alias("file_count"), F.sum("length").alias("total_bytes"),
            F.min("modificationTime").alias("first_modified"),
            F.max("modificationTime").alias("last_modified"),
            variants("file_name").alias("file_names"),
        )
    )
