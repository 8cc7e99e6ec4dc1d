"""Streaming jobs: route a feed, keep a change history up to date.

Every micro-batch writes under its own batch number with overwrite, so a
batch replayed after a failure replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from dqlake.operators.rules import VALID, quarantine, valid_rows
from dqlake.operators.scd import (
    END, HOT_ROWS, LAST, START, late_keys, late_stretches, scd2, scd2_splice, touched_versions, with_last, without,
)
from dqlake.operators.waiting import ROW_ID, arrived, retest, waiting_index, with_row_id

BATCH = "batch_id"
BUCKET = "bucket"
PART = "part"


def run_once(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Process everything available, batch by batch, then stop."""
    query = (
        stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def _beside(sink: str, what: str) -> str:
    return f"{sink.rstrip('/')}-{what}"


def route_feed(
    stream: DataFrame, validated: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str,
    key: str | None = None, waits: Mapping[str, str] | None = None, buckets: int = 64,
) -> None:
    """Validate a feed and append it to ``sink``, split by validity.

    ``validated`` turns raw rows into validated rows. It runs inside the batch,
    so joins to static tables are planned by AQE from the current table sizes,
    and once: one write, partitioned by the outcome, serves both sides.

    With ``key``, hashes of the accepted keys are kept beside the sink, and accepted rows whose key an
    earlier batch accepted, or that comes twice in theirs, are listed for ``read_reissued``. With
    ``waits`` (rule name to key column), rejected rows are indexed by the parent they lack, for
    ``release``; ``validated`` must then pass ``_row_id`` through.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        out = validated(with_row_id(batch) if waits else batch)
        out.write.mode("overwrite").partitionBy(VALID).parquet(f"{sink}/{BATCH}={batch_id}")
        written = _read_if_there(batch.sparkSession, f"{sink}/{BATCH}={batch_id}")
        if written is None:
            return
        written = written.withColumn(VALID, F.col(VALID).cast("boolean"))
        if waits:
            index = waiting_index(written.where(~F.col(VALID)), waits)
            index.write.mode("overwrite").parquet(f"{_beside(sink, 'waiting')}/{BATCH}={batch_id}")
        if key:
            _note_keys(written.where(F.col(VALID)), key, sink, batch_id, buckets)

    run_once(stream, checkpoint, each)


def _note_keys(accepted: DataFrame, key: str, sink: str, batch_id: int, buckets: int) -> None:
    """Keep the hashes of a batch's keys and list the keys that were there before.

    The hashes of earlier batches are read for the batch's buckets only, and narrow; rows accepted
    earlier are read only where a hash is known, to compare the key itself.
    """
    spark, store, found = accepted.sparkSession, _beside(sink, "keys"), f"{_beside(sink, 'reissued')}/{BATCH}={batch_id}"
    own = accepted.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    own = own.withColumn("__hash", F.xxhash64(key)).withColumn(BUCKET, _bucket([key], buckets))
    own.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{store}/{BATCH}={batch_id}")
    keys = _read_if_there(spark, f"{store}/{BATCH}={batch_id}")
    if keys is None:
        return
    # at most ``buckets`` small integers
    numbers = [r[0] for r in keys.select(BUCKET).distinct().collect()]
    earlier = spark.read.parquet(store).where((F.col(BATCH) < batch_id) & F.col(BUCKET).isin(numbers)).select("__hash")
    maybe = keys.join(earlier, "__hash", "left_semi").select(key)
    if maybe.isEmpty():
        seen = maybe
    else:
        before = spark.read.parquet(sink).where((F.col(BATCH) < batch_id) & (F.col(VALID).cast("boolean")))
        seen = before.select(key).join(maybe, key, "left_semi").distinct()
    marked = keys.select(key, "row_count").join(seen.withColumn("__seen", F.lit(True)), key, "left")
    marked = marked.select(key, "row_count", F.coalesce("__seen", F.lit(False)).alias("in_target"))
    marked.where("row_count > 1 OR in_target").write.mode("overwrite").parquet(found)


def read_reissued(spark: SparkSession, sink: str) -> DataFrame:
    """(batch_id, key, row_count, in_target): keys that were accepted again."""
    return spark.read.parquet(_beside(sink, "reissued"))


def release(
    spark: SparkSession, sink: str, raw: DataFrame, parents: Mapping[str, DataFrame],
    revalidate: Callable[[DataFrame], DataFrame],
) -> int:
    """Test the rejected rows again whose missing parent has come; their outcome replaces the old one.

    ``raw`` is the feed's raw table, ``parents`` holds the keys there now for each rule of ``waits``.
    The index is joined to the keys; only the rows it gives are read and tested, once for each parent
    that comes. Returns how many entries were answered; repeating a run finds none.
    """
    index = _read_if_there(spark, _beside(sink, "waiting"))
    if index is None:
        return 0
    answered = _read_if_there(spark, _beside(sink, "answered"))
    entry = ["reason", "parent_key", ROW_ID]
    open_ = index.select(*entry)
    if answered is not None:
        open_ = open_.join(answered.select(*entry).distinct(), entry, "left_anti")
    # answers are noted last, so that a run that broke off is done again under the same number
    number = 0 if answered is None else answered.agg(F.coalesce(F.max("run"), F.lit(-1))).first()[0] + 1
    fresh = f"{_beside(sink, 'arrived')}"
    arrived(open_, parents).write.mode("overwrite").parquet(fresh)
    entries = spark.read.parquet(fresh)
    found = entries.count()
    if found:
        rows = retest(with_row_id(raw), entries, revalidate)
        rows.write.mode("overwrite").parquet(f"{_beside(sink, 'retested')}/run={number}")
        entries.write.mode("overwrite").parquet(f"{_beside(sink, 'answered')}/run={number}")
    return found


def _read_routed(spark: SparkSession, sink: str) -> DataFrame:
    df = spark.read.option("mergeSchema", False).parquet(sink).drop(BATCH)
    return df.withColumn(VALID, F.col(VALID).cast("boolean"))


def _retested(spark: SparkSession, sink: str) -> DataFrame | None:
    """The last outcome of each row that was tested again."""
    rows = _read_if_there(spark, _beside(sink, "retested"))
    if rows is None:
        return None
    last = F.max("run").over(Window.partitionBy(ROW_ID))
    return rows.withColumn("__last", last).where("run = __last").drop("run", "__last")


def read_valid(spark: SparkSession, sink: str) -> DataFrame:
    """Accepted rows of a routed feed, those accepted by a later test included; reads only their partitions."""
    rows, again = valid_rows(_read_routed(spark, sink)), _retested(spark, sink)
    return rows.drop(ROW_ID) if again is None else rows.unionByName(valid_rows(again)).drop(ROW_ID)


def read_quarantine(spark: SparkSession, sink: str, as_of: Column) -> DataFrame:
    """Rejected rows of a routed feed with the reasons of their last test."""
    rows, again = quarantine(_read_routed(spark, sink), as_of), _retested(spark, sink)
    if again is not None:
        rows = rows.join(again.select(ROW_ID).distinct(), ROW_ID, "left_anti").unionByName(quarantine(again, as_of))
    return rows.drop(ROW_ID)


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def apply_changes(
    spark: SparkSession, stream: DataFrame, keys: Sequence[str], sequence: Sequence[str], log: str,
    history: str, checkpoint: str, buckets: int = 64, track_except: Sequence[str] = (),
    drop: Sequence[str] = (), hot_rows: int | None = HOT_ROWS, compact_every: int = 32,
) -> None:
    """Keep a type 2 history of a stream of accepted changes, which may arrive in any order.

    The rows are appended to ``log``. Open and closed versions are stored apart, each by key bucket. A
    batch that follows what is known reads and rewrites the open versions of its buckets only, and
    appends the versions it closes. Late rows splice: their buckets' closed versions are read and
    rewritten, and the log is read between the neighbours of the late rows (see ``scd2_splice``). Every
    ``compact_every``-th batch rewrites the closed versions of its buckets, which the appends
    have left in many files. Limit a batch where the stream is read, e.g. by ``maxFilesPerTrigger``.

    A replayed batch may follow a half-done swap of buckets, so it trusts the log alone and rebuilds its
    buckets whole. The number of buckets is kept beside the history, and a call with another one is
    refused: rows filed under the old number would be missed.
    """
    layout = f"{history.rstrip('/')}-layout"
    known = _read_if_there(spark, layout)
    if known is None:
        spark.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(layout)
    elif known.first().buckets != buckets:
        raise ValueError(f"{history} is stored in {known.first().buckets} buckets, not {buckets}")
    options = dict(track_except=track_except, drop=drop, hot_rows=hot_rows)
    base = history.rstrip("/")

    def read(part: str) -> DataFrame | None:
        stored = _read_if_there(spark, f"{base}/{PART}={part}")
        return None if stored is None else stored.where(F.col(START).isNotNull())

    def write(df: DataFrame, part: str, mode: str, swapped: Sequence[int] = ()) -> None:
        rows = df.withColumn(BUCKET, _bucket(keys, buckets))
        if swapped:
            # A bucket left without versions keeps a row that is none, or its old files would stay.
            rows = rows.unionByName(spark.createDataFrame([(b,) for b in swapped], f"{BUCKET} int"), allowMissingColumns=True)
        (
            # AQE sizes the files: small buckets share a task, a big one is split.
            rows.hint("rebalance", BUCKET).write.mode(mode).option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET).parquet(f"{base}/{PART}={part}")
        )

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{base}-{name}")
        return spark.read.parquet(f"{base}-{name}")

    def rebuild(changes: DataFrame, numbers: Sequence[int]) -> None:
        whole = kept(scd2(with_last(changes, sequence), keys, sequence, [*track_except, LAST], drop, hot_rows), "formed")
        write(whole.where(F.col(END).isNotNull()), "closed", "overwrite", numbers)
        write(whole.where(F.col(END).isNull()), "open", "overwrite")

    def splice(batch_id: int, rows: DataFrame, changes: DataFrame, heads: DataFrame, numbers: Sequence[int]) -> None:
        late = late_keys(heads, rows, keys, sequence).select(_bucket(keys, buckets).alias(BUCKET)).distinct()
        late_buckets = [r[0] for r in late.collect()]
        swapped = numbers if (batch_id + 1) % compact_every == 0 else late_buckets
        closed = read("closed").where(F.col(BUCKET).isin(swapped)) if swapped else None
        near, past = heads.drop(BUCKET), changes.where(F.lit(False))
        if late_buckets:
            near = near.unionByName(closed.where(F.col(BUCKET).isin(late_buckets)).drop(BUCKET))
        touched = kept(touched_versions(near, rows, keys, sequence), "touched")
        if late_buckets:
            past = changes.where(F.col(BUCKET).isin(late_buckets))
            first = late_stretches(touched, keys).agg(F.min("__from").alias("at")).first()["at"]
            if first[0] is not None:
                # the log's files are those of deliveries, so the earliest sequence leaves most of them unread
                past = past.where(F.col(sequence[0]) >= F.lit(first[0]))
        formed = kept(scd2_splice(touched, past.select(*rows.columns), rows, keys, sequence, **options), "formed")
        gone, done, open_ = touched.select(*keys, START), formed.where(F.col(END).isNotNull()), formed.where(F.col(END).isNull())
        in_swapped = _bucket(keys, buckets).isin(swapped)
        if swapped:
            write(without(closed.drop(BUCKET), gone, keys).unionByName(done.where(in_swapped)), "closed", "overwrite", swapped)
        if len(swapped) < len(numbers):
            write(done.where(~in_swapped), "closed", "append")
        write(without(heads.drop(BUCKET), gone, keys).unionByName(open_), "open", "overwrite")

    def each(batch: DataFrame, batch_id: int) -> None:
        own = f"{log}/{BATCH}={batch_id}"
        replayed = _read_if_there(spark, own) is not None
        batch.withColumn(BUCKET, _bucket(keys, buckets)).write.mode("overwrite").partitionBy(BUCKET).parquet(own)
        written = _read_if_there(spark, own)
        if written is None:
            return
        # At most ``buckets`` small integers.
        numbers = [r[0] for r in written.select(BUCKET).distinct().collect()]
        changes, heads = spark.read.parquet(log), read("open")
        if replayed or heads is None:
            rebuild(changes.where(F.col(BUCKET).isin(numbers)).select(*batch.columns), numbers)
        else:
            splice(batch_id, written.select(*batch.columns), changes, heads.where(F.col(BUCKET).isin(numbers)), numbers)

    run_once(stream, checkpoint, each)


def read_history(spark: SparkSession, history: str) -> DataFrame:
    stored = spark.read.parquet(history).where(F.col(START).isNotNull())
    return stored.drop(PART, BUCKET, LAST)
