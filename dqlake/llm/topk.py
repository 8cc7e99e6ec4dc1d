"""Exact top-k inner-product search by distributed histogram selection.

Every query is scored against every vector, in blocks: vectors are packed into chunks, queries
into blocks, and a chunk meets a block as one matrix product. A pass counts each query's scores
in equal bins between two bounds; the counts are summed over the cluster, the bin that holds the
k-th score becomes the next bounds. When the bin holds few scores or is one score wide, its lower
end is the query's threshold; a last pass keeps what reaches it, at most k rows of each chunk,
and breaks ties by the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import keep, partitions

BINS = 256
#: Vectors of a chunk and queries of a block; both fit in a task many times over.
CHUNK, BLOCK = 8192, 1024
#: Scores in the bin of the k-th at which refining ends.
FEW = 64


def _packed(scale: int, rows: int):
    """Chunks (dim, n, ids, values): components as floor(scale * x), exact in doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(dim: int, ids: list, vectors: list) -> pa.RecordBatch:
            m = np.array(vectors, np.float64)
            return pa.RecordBatch.from_arrays(
                [pa.array([dim]), pa.array([len(ids)]), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                 pa.array([m.tobytes()], pa.binary()), pa.array([float(np.sqrt((m * m).sum(1).max()))])],
                ["dim", "n", "ids", "vectors", "longest"])

        open_: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if i is None or not v.is_valid:
                    continue
                v = v.values
                x = v.to_numpy(zero_copy_only=False).astype(np.float64)
                if v.null_count or not len(x) or not np.isfinite(x).all():
                    continue
                ids, vectors = open_.setdefault(len(x), ([], []))
                ids.append(i), vectors.append(np.floor(scale * x))
                if len(ids) == rows:
                    yield emit(len(x), *open_.pop(len(x)))
        for dim, (ids, vectors) in open_.items():
            yield emit(dim, ids, vectors)

    return run


def _read(dim: int, ids: bytes, values: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(values, np.float64).reshape(-1, dim)


def _met(batch: pa.RecordBatch) -> Iterator[tuple]:
    for r in batch.to_pylist():
        ids, vectors = _read(r["dim"], r["ids"], r["vectors"])
        own, queries = _read(r["dim"], r["query_ids"], r["queries"])
        scores = (queries @ vectors.T).astype(np.int64)
        yield own, ids, scores, r


def _histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for own, ids, scores, r in _met(batch):
            low, width, done = (np.frombuffer(r[k], np.int64) for k in ("low", "width", "done"))
            bins = (scores - low[:, None]) // width[:, None]
            use = (bins >= 0) & (own[:, None] != ids[None, :]) & (done[:, None] == 0)
            bins = np.minimum(bins, BINS)  # the last one: above the bounds
            flat = (np.arange(len(own))[:, None] * (BINS + 1) + bins)[use]
            counts = np.bincount(flat, minlength=len(own) * (BINS + 1))
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(own[at // (BINS + 1)]), pa.array(at % (BINS + 1)), pa.array(counts[at])],
                                             ["query_id", "bin", "n"])


def _best(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, ids, scores, r in _met(batch):
                low = np.frombuffer(r["low"], np.int64)
                q, v = np.nonzero((scores >= low[:, None]) & (own[:, None] != ids[None, :]))
                s = scores[q, v]
                by = np.lexsort((ids[v], -s, q))
                q, v, s = q[by], v[by], s[by]
                start = np.searchsorted(q, q)
                take = np.arange(len(q)) - start < k
                yield pa.RecordBatch.from_arrays([pa.array(own[q[take]]), pa.array(ids[v[take]]), pa.array(s[take])],
                                                 ["query_id", "vec_id", "score"])

    return run


def _blocks(bounds: DataFrame) -> DataFrame:
    """Queries with their bounds packed into blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rows = sorted(r["rows"], key=lambda x: x["query_id"])
                yield pa.RecordBatch.from_pylist([{
                    "dim": r["dim"], "block": r["block"],
                    "query_ids": np.array([x["query_id"] for x in rows], np.int64).tobytes(),
                    "queries": b"".join(x["query"] for x in rows),
                    **{k: np.array([x[k] for x in rows], np.int64).tobytes() for k in ("low", "width", "done")}}],
                    schema=pa.schema([("dim", pa.int64()), ("block", pa.int64()), *((k, pa.binary()) for k in
                                     ("query_ids", "queries", "low", "width", "done"))]))

    packed = bounds.groupBy("dim", "block").agg(F.collect_list(F.struct("query_id", "query", "low", "width", "done")).alias("rows"))
    return packed.mapInArrow(run, "dim long, block long, query_ids binary, queries binary, low binary, width binary, done binary")


def _queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per query out of packed chunks."""
    for batch in batches:
        for r in batch.to_pylist():
            ids, vectors = _read(r["dim"], r["ids"], r["vectors"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["dim"]] * len(ids), pa.int64()), pa.array(ids), pa.array([v.tobytes() for v in vectors], pa.binary()),
                 pa.array(np.ceil(np.sqrt((vectors * vectors).sum(1))))], ["dim", "query_id", "query", "norm"])


def exact_topk(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id",
               vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query.

    Components count as floor(scale * x). A query is a row for which ``is_query`` holds; candidates
    are all rows with another id, of the same number of components; fewer than k give fewer rows.
    Equal scores go to the smaller id. Vectors that are null or empty, have no id, or hold null or
    non-finite components take no part. Repeated rows of an id: as a query it counts once, as a
    candidate it may be named more than once. Other columns are not read. Sums up to 2^53 are exact.
    """
    spark = vectors.sparkSession
    cols = [F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")]
    layout = "dim long, n long, ids binary, vectors binary, longest double"
    chunks = keep(vectors.select(*cols).mapInArrow(_packed(scale, CHUNK), layout), "chunks")
    queries = keep(vectors.where(is_query).select(*cols).mapInArrow(_packed(scale, BLOCK), layout).mapInArrow(
        _queries, "dim long, query_id long, query binary, norm double").dropDuplicates(["query_id"]), "queries")
    longest = chunks.groupBy("dim").agg(F.ceil(F.max("longest")).alias("longest"))
    total = queries.count()
    n_blocks = max(1, -(-total // BLOCK))
    bound = (F.col("norm") * F.col("longest")).cast("long") + 1
    bounds = keep(queries.join(longest, "dim").withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)))
                  .select("dim", "block", "query_id", "query", (-bound).alias("low"),
                          F.ceil((2 * bound + 1) / BINS).cast("long").alias("width"), F.lit(0).cast("long").alias("done")), "bounds")
    # a chunk goes to every block once; copies of a block stand ready in several partitions
    lanes = max(1, partitions(spark) // n_blocks)
    # as many chunks on each lane
    numbered = chunks.withColumn("lane", F.pmod(F.xxhash64("ids"), F.lit(lanes)))

    def meet(now: DataFrame) -> DataFrame:
        blocks = _blocks(now).withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))))
        spread = numbered.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
        return spread.join(blocks, ["dim", "block", "lane"])

    while True:
        counts = (meet(bounds).mapInArrow(_histograms, "query_id long, bin long, n long")
                  .groupBy("query_id", "bin").agg(F.sum("n").alias("n")))
        # scores above the bin, from the top; the k-th stands in the first bin where k are reached
        down = Window.partitionBy("query_id").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        hit = (counts.withColumn("upto", F.sum("n").over(down)).where(F.col("upto") >= k)
               .groupBy("query_id").agg(F.max("bin").alias("bin"), F.min("upto").alias("upto")))
        new = (bounds.join(hit, "query_id", "left")
               .withColumn("found", F.col("low") + F.col("bin") * F.col("width"))
               # fewer than k scores: everything counts; above the bounds: can't be with true bounds
               .withColumn("end", F.when(F.col("done") == 1, 1).when(F.col("bin").isNull(), 1)
                           .when((F.col("width") == 1) | (F.col("upto") <= FEW), 1).otherwise(0).cast("long"))
               .select("dim", "block", "query_id", "query",
                       F.when(F.col("done") == 1, F.col("low")).otherwise(F.coalesce("found", "low")).alias("low"),
                       F.when(F.col("end") == 1, F.col("width")).otherwise(F.ceil(F.col("width") / BINS).cast("long")).alias("width"),
                       F.col("end").alias("done")))
        bounds = keep(new, "bounds")
        if bounds.where("done = 0").isEmpty():
            break
    best = meet(bounds).mapInArrow(_best(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
