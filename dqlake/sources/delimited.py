"""Delimited text bound to columns by the header of each file.

Files of one folder may differ in the order of their columns, lack some or have more. Every file's own
header says which field is which; what a table has no column for is kept in the rescue column.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.readwriter import DataFrameReader
from pyspark.sql.streaming import DataStreamReader

RESCUED = "_rescued_data"
FILE = "_source_file"
LINE = "__line"

# A character no delivery uses: the reader then hands over lines as they are.
_UNUSED = "\u0001"


def read_lines(reader: DataFrameReader | DataStreamReader, path: str) -> DataFrame:
    """Lines of the files of a folder without their headers, as ``__line``.

    Works on batch and streaming readers; file metadata can be selected from the result. Blank
    lines are no records. A quoted field can't hold a line break: its lines count as malformed.
    """
    raw = (
        reader.schema("value STRING, whole STRING").option("header", True).option("sep", _UNUSED)
        .option("quote", "").option("columnNameOfCorruptRecord", "whole").csv(path)
    )
    return raw.withColumn(LINE, F.coalesce("whole", "value")).drop("whole", "value")


def header_lines(spark: SparkSession, path: str, files: Sequence[str] | None = None) -> DataFrame:
    """(_source_file, __line): the first line of each file of a folder, or of ``files`` of it only.

    The files are read once as plain lines; only the first of each leaves its task.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("__start"),
        "value", F.monotonically_increasing_id().alias("__at"))
    if files is not None:
        lines = lines.where(F.col(FILE).isin(*files))
    return lines.where("__start = 0").groupBy(FILE).agg(F.min_by("value", "__at").alias(LINE))


def raw_fields(line: Column, sep: str = ",") -> Column:
    """The fields of a line as they stand: quoted ones with their quotes, which double inside."""
    s = re.escape(sep)
    pattern = rf'{s}("[^"]*+(?:""[^"]*+)*+"|[^"{s}][^{s}]*+|)'
    return F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(pattern), F.lit(1))


def well_formed(line: Column, raw: Column) -> Column:
    """Whether the raw fields and the separators before them make up the whole line."""
    size = F.aggregate(raw, F.lit(0), lambda n, x: n + F.length(x))
    return size + F.size(raw) == F.length(line) + 1


def field_values(raw: Column) -> Column:
    """Quotes taken off; an empty field without quotes is NULL."""

    def inner(x: Column) -> Column:
        return F.replace(F.substr(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))

    return F.transform(raw, lambda x: F.when(x.startswith('"'), inner(x)).otherwise(F.nullif(x, F.lit(""))))


def bindings(headers: DataFrame, columns: Sequence[str], sep: str = ",") -> DataFrame:
    """How each file's fields meet ``columns``, from ``header_lines``.

    ``names`` are the header's, ``at`` the place (from 0) of each wanted column in the file or NULL,
    ``extra`` the places and rescue keys of the others. Names match without regard to case and
    outer blanks; of a repeated name the first is bound. Fields that no name tells apart go by their
    place, ``#1`` being the first.
    """
    line = F.regexp_replace(LINE, "^﻿", "")
    names = F.transform(field_values(raw_fields(line, sep)), lambda x: F.trim(F.coalesce(x, F.lit(""))))
    own = headers.select(FILE, names.alias("names")).withColumn("__low", F.transform("names", F.lower))
    wanted = F.array(*[F.lit(c.lower()) for c in columns])
    place = F.transform(wanted, lambda c: F.nullif(F.array_position("__low", c), F.lit(0)) - 1)
    each = F.transform("names", lambda name, i: F.struct(i.alias("at"), name.alias("name")))

    def first(e: Column) -> Column:
        return F.array_position("__low", F.lower(e["name"])) == e["at"] + 1

    extra = F.filter(each, lambda e: ~(first(e) & F.array_contains(wanted, F.lower(e["name"]))))
    keyed = F.transform(extra, lambda e: F.struct(e["at"].alias("at"), F.when(
        first(e) & (e["name"] != "") & ~e["name"].startswith("#") & (e["name"] != "_line"), e["name"]
    ).otherwise(F.concat(F.lit("#"), (e["at"] + 1).cast("string"))).alias("key")))
    return own.select(FILE, "names", place.alias("at"), keyed.alias("extra"))


def bind(lines: DataFrame, bound: DataFrame, columns: Sequence[str], sep: str = ",") -> DataFrame:
    """``lines`` (with ``_source_file``) as ``columns``, all text, and ``_rescued_data``.

    Nothing of a line is lost. The rescue column holds, as JSON, the values of unknown columns by name
    and fields beyond the header by place. A line that is no sequence of fields, such as one with an open
    quote, or whose file has no header, is kept there whole under ``_line`` and has no column values.
    Missing fields at the end of a line are NULL.
    """
    kept = [c for c in lines.columns if c not in (LINE, FILE)]
    met = lines.join(bound, FILE, "left")
    met = met.withColumn("__raw", raw_fields(F.col(LINE), sep))
    met = met.withColumn("__ok", F.col("names").isNotNull() & well_formed(F.col(LINE), F.col("__raw")))
    met = met.withColumn("__fields", F.when(F.col("__ok"), field_values(F.col("__raw"))))
    values = [F.get("__fields", F.get("at", F.lit(i))).alias(c) for i, c in enumerate(columns)]

    def entry(key: Column, value: Column) -> Column:
        return F.struct(key.alias("key"), value.alias("value"))

    unknown = F.filter(F.transform("extra", lambda e: entry(e["key"], F.get("__fields", e["at"]))),
                       lambda e: e["value"].isNotNull())
    more = F.size("__fields") - F.size("names")
    beyond = F.transform(F.slice("__fields", F.size("names") + 1, F.greatest(more, F.lit(0))), lambda x, i: entry(
        F.concat(F.lit("#"), (i + 1 + F.size("names")).cast("string")), F.coalesce(x, F.lit(""))))
    lost = F.concat(unknown, beyond)
    rescued = F.when(~F.col("__ok"), F.to_json(F.struct(F.col(LINE).alias("_line")))).when(
        F.size(lost) > 0, F.to_json(F.map_from_entries(lost)))
    return met.select(*values, FILE, *kept, rescued.alias(RESCUED))


def header_drift(bound: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per file whose header is not ``columns``: what is missing, unknown, out of order."""
    wanted = F.array(*[F.lit(c) for c in columns])
    known = F.filter("at", lambda p: p.isNotNull())
    missing = F.transform(F.filter(F.arrays_zip(wanted.alias("name"), F.col("at").alias("at")), lambda e: e["at"].isNull()),
                          lambda e: e["name"])
    out = bound.select(
        FILE, F.concat_ws(",", missing).alias("missing_columns"),
        F.concat_ws(",", F.transform("extra", lambda e: e["key"])).alias("unknown_columns"),
        (known != F.array_sort(known)).alias("reordered"))
    return out.where("missing_columns <> '' OR unknown_columns <> '' OR reordered")
