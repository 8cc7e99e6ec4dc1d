"""Exact hard negatives by an inverted multi-index.

Vectors are cut into two halves, each half has a codebook, and a pair of codes is a cell. A vector's
product with a query is at most, and at least, the sum of two half scores: that of the half's code
plus or minus the query half's length times the code's radius. A query visits cells by falling sum of
its upper half bounds, which a heap over two sorted sequences gives one by one (multi-sequence
algorithm). It looks for the best scores within windows; a window is certified, and stops, once the
bound of the next cell is below its worst kept score or below its lower end. Visits go in rounds: the
rows of a cell are held by tasks while the queries that ask for the cell stream past.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import keep
from .probing import each_lane, held, one_lane, stream_past

#: Rows the codebooks are fitted on at most (every row is indexed), codes of a half at most, rows of a
#: cell on average where the codes allow it, steps of the fitting.
SAMPLE, CODES, CELL, STEPS = 8192, 256, 256, 8
#: Rows a query visits in its first round, and how much more in each further one.
FIRST, MORE = 2048, 4
#: Numbers of a lane's vectors, and scores made at once, at most.
LANE, SCORES = 1 << 22, 1 << 22

ROW = "id long, label long, cell long, vector binary"


def _codes(points: np.ndarray, n: int) -> np.ndarray:
    """Codebook of one half: centroids by Lloyd's steps from points spread over the sample."""
    points = np.unique(points, axis=0)
    made = points[np.linspace(0, len(points) - 1, min(n, len(points))).astype(int)]
    for _ in range(STEPS):
        own = _nearest(points, made)
        sums = np.zeros_like(made)
        np.add.at(sums, own, points)
        n_own = np.bincount(own, minlength=len(made))
        made[n_own > 0] = sums[n_own > 0] / n_own[n_own > 0, None]
    return made


def _nearest(points: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return ((codes * codes).sum(1)[None, :] - 2 * points @ codes.T).argmin(1)


def _vectors(column: pa.Array, scale: int) -> list[np.ndarray | None]:
    """floor(scale * x) of each vector; None for what takes no part."""
    out: list[np.ndarray | None] = []
    for v in column:
        x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) if v.is_valid and v.values.null_count == 0 else np.zeros(0)
        out.append(np.floor(scale * x) if len(x) and np.isfinite(x).all() else None)
    return out


class Codebooks:
    """For each number of components two codebooks; one it has not seen has a single code, zero."""

    def __init__(self, sample: list[np.ndarray], codes: int):
        self.width = codes
        self.books: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        by_dim: dict[int, list[np.ndarray]] = {}
        for v in sample:
            by_dim.setdefault(len(v), []).append(v)
        for dim, rows in by_dim.items():
            m = np.array(rows)
            self.books[dim] = (_codes(m[:, :dim // 2], codes), _codes(m[:, dim // 2:], codes))

    def of(self, dim: int) -> tuple[np.ndarray, np.ndarray]:
        return self.books.get(dim) or (np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2)))

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cells, and each half's distance to its code."""
        dim = vectors.shape[1]
        first, second = vectors[:, :dim // 2], vectors[:, dim // 2:]
        one, two = self.of(dim)
        i, j = _nearest(first, one), _nearest(second, two)
        return ((dim * self.width + i) * self.width + j, np.linalg.norm(first - one[i], axis=1),
                np.linalg.norm(second - two[j], axis=1))


class Cells:
    """What a query must know of the index: for each dimension the codes' radii and the filled cells.
    At most ``CODES`` ** 2 cells a dimension, however many rows."""

    def __init__(self, books: Codebooks, rows: list):
        self.books, self.filled = books, {}
        self.radii: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        w = books.width
        for r in rows:
            dim, i, j = r.cell // (w * w), r.cell // w % w, r.cell % w
            self.filled[r.cell] = r.n
            one, two = self.radii.setdefault(dim, (np.zeros(w), np.zeros(w)))
            one[i], two[j] = max(one[i], r.far_1), max(two[j], r.far_2)

    def visit(self, q: np.ndarray) -> Iterator[tuple[float, float, int]]:
        """(upper bound, lower bound, cell) of the filled cells by falling upper bound."""
        dim, w = len(q), self.books.width
        if dim not in self.radii:
            return
        halves = []
        for half, codes, radii in zip((q[:dim // 2], q[dim // 2:]), self.books.of(dim), self.radii[dim], strict=True):
            score, reach = codes @ half, np.linalg.norm(half) * radii[:len(codes)]
            slack = 1e-9 * (np.abs(score) + reach) + 1e-6  # doubles round; scores are whole numbers
            halves.append((score + reach + slack, score - reach - slack))
        (up_1, low_1), (up_2, low_2) = halves
        by_1, by_2 = np.argsort(-up_1, kind="stable"), np.argsort(-up_2, kind="stable")
        heap = [(-(up_1[by_1[0]] + up_2[by_2[0]]), 0, 0)]
        while heap:
            bound, a, b = heapq.heappop(heap)
            i, j = by_1[a], by_2[b]
            # each pair enters once: rows of the grid start from the first column
            if b + 1 < len(by_2):
                heapq.heappush(heap, (-(up_1[i] + up_2[by_2[b + 1]]), a, b + 1))
            if b == 0 and a + 1 < len(by_1):
                heapq.heappush(heap, (-(up_1[by_1[a + 1]] + up_2[j]), a + 1, 0))
            cell = int((dim * w + i) * w + j)
            if cell in self.filled:
                yield -bound, float(low_1[i] + low_2[j]), cell


def _index(books: Codebooks, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_dim: dict[int, list[int]] = {}
            made = _vectors(batch.column(2), scale)
            for row, v in enumerate(made):
                if v is not None and batch.column(0)[row].is_valid and batch.column(1)[row].is_valid:
                    by_dim.setdefault(len(v), []).append(row)
            for rows in by_dim.values():
                m = np.array([made[r] for r in rows])
                cell, far_1, far_2 = books.assign(m)
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(cell), pa.array([v.tobytes() for v in m], pa.binary()),
                     pa.array(far_1), pa.array(far_2)], ["id", "label", "cell", "vector", "far_1", "far_2"])

    return run


def _plan(cells: Cells, budget: int):
    """The cells each query visits next, and the bound of what it leaves unvisited."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                highest, rows, ask, rest = max(w["high"] for w in r["windows"]), 0, [], -np.inf
                for seen, (upper, lower, cell) in enumerate(cells.visit(np.frombuffer(r["vector"], np.float64))):
                    if seen < r["done"]:
                        continue
                    if rows >= budget:
                        rest = upper
                        break
                    r["done"] = seen + 1
                    if lower <= highest:
                        ask.append(cell)
                        rows += cells.filled[cell]
                out.append({"id": r["id"], "done": r["done"], "rest": float(rest), "cells": ask})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("id", pa.int64()), ("done", pa.int64()), ("rest", pa.float64()),
                                                                    ("cells", pa.list_(pa.int64()))]))

    return run


def _score(k: int, same: bool):
    """The k best rows of each window of each query among the rows held: of the query's label or of
    other labels, its own id left out."""

    def load(piece: pa.RecordBatch) -> tuple:
        get = piece.schema.get_field_index
        ids, labels = (piece.column(get(c)).to_numpy() for c in ("id", "label"))
        return ids, labels, np.frombuffer(b"".join(piece.column(get("vector")).to_pylist()), np.float64).reshape(len(ids), -1)

    def best(own: np.ndarray, asks: list[dict], held_: tuple) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = held_
        scores = own @ vectors.T
        label = np.array([r["label"] for r in asks])
        fit = (labels[None, :] == label[:, None]) == same
        fit &= ids[None, :] != np.array([r["id"] for r in asks])[:, None]
        queries, windows = zip(*[(i, w) for i, r in enumerate(asks) for w in r["windows"]], strict=True)
        at = np.array(queries)
        low = np.array([max(w["low"], w["least"] if w["least"] is not None else w["low"]) for w in windows], np.float64)
        high = np.array([w["high"] for w in windows], np.float64)
        for start in range(0, len(at), max(1, SCORES // max(1, len(ids)))):
            part = slice(start, start + max(1, SCORES // max(1, len(ids))))
            s = scores[at[part]]
            ok = fit[at[part]] & (s >= low[part, None]) & (s <= high[part, None])
            if s.shape[1] > k:  # the k-th best score of each window is enough; equal ones are cut below
                worst = -np.partition(np.where(ok, -s, np.inf), k - 1, axis=1)[:, k - 1]
                ok &= s >= worst[:, None]
            w, v = np.nonzero(ok)
            if not len(w):
                continue
            by = np.lexsort((ids[v], -s[w, v], w))
            w, v = w[by], v[by]
            take = np.arange(len(w)) - np.searchsorted(w, w) < k
            w, v = w[take], v[take]
            yield pa.RecordBatch.from_arrays(
                [pa.array([asks[q]["id"] for q in at[part][w]], pa.int64()), pa.array([windows[start + x]["w"] for x in w], pa.int32()),
                 pa.array(ids[v]), pa.array(s[w, v].astype(np.int64))], ["query", "w", "id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts, asks in held(batches, "cell", load):
            for start in range(0, asks.num_rows, 256):
                rows = asks.slice(start, 256).select(["id", "label", "vector", "windows"]).to_pylist()
                own = np.array([np.frombuffer(r["vector"], np.float64) for r in rows])
                for part in parts:
                    yield from best(own, rows, part)

    return run


class MultiIndex:
    """Inverted multi-index over the rows of a table that have an id, a label and a finite vector."""

    def __init__(self, rows: DataFrame, scale: int = 256, id_col: str = "vec_id", label: Column | None = None,
                 vector_col: str = "embedding"):
        given = rows.select(F.col(id_col).cast("long").alias("id"), (F.col("label") if label is None else label).cast("long").alias("label"),
                            F.col(vector_col).alias("vector"))
        n = given.count()
        share = min(1.0, SAMPLE / max(n, 1)) * (1 << 32)
        picked = given.where(F.pmod(F.xxhash64("id"), F.lit(1 << 32)) < F.lit(share)).limit(2 * SAMPLE).toArrow()
        sample = [v for v in _vectors(picked.column("vector").combine_chunks(), scale) if v is not None]
        self.books = Codebooks(sample, max(1, min(CODES, round((n / CELL) ** 0.5))))
        self.rows = keep(given.mapInArrow(_index(self.books, scale), ROW + ", far_1 double, far_2 double")
                         .withColumn("salt", F.monotonically_increasing_id()), "indexed")
        summary = self.rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("far_1").alias("far_1"), F.max("far_2").alias("far_2"),
                                                F.max(F.octet_length("vector")).alias("bytes"))
        # at most CODES ** 2 rows a dimension
        self.summary = keep(summary, "cells")
        self.cells = Cells(self.books, self.summary.collect())
        lanes = F.ceil(F.col("n") * F.col("bytes") / (8 * LANE)).cast("int")
        self.lanes = F.broadcast(self.summary.select("cell", lanes.alias("lanes")).where("lanes > 1"))

    def search(self, queries: DataFrame, windows: DataFrame, same: bool, k: int) -> DataFrame:
        """(query, w, id, score): the k best rows of each window, exact; ties by smaller id.

        ``queries``: (id, label, vector) of the index, an id once; ``windows``: (query, w, low, high),
        bounds included. ``same`` asks for rows of the query's label, else for rows of other labels.
        """
        parts = one_lane(self.rows.select("id", "label", "cell", "vector", "salt"), "cell", self.lanes, "salt").drop("salt")
        open_ = keep(windows.select("query", "w", "low", "high", F.lit(None).cast("long").alias("least"), F.lit(0).cast("long").alias("done")),
                     "windows")
        order = Window.partitionBy("query", "w").orderBy(F.desc("score"), "id")
        best, budget = None, FIRST
        while not open_.isEmpty():
            per_query = open_.groupBy("query").agg(F.collect_list(F.struct("w", "low", "high", "least")).alias("windows"),
                                                   F.max("done").alias("done"))
            asking = queries.join(per_query, queries["id"] == per_query["query"]).drop("query")
            plan = keep(asking.select("id", "vector", "windows", "done").mapInArrow(
                _plan(self.cells, budget), "id long, done long, rest double, cells array<long>"), "plan")
            asks = asking.select("id", "label", "vector", "windows").join(plan.select("id", F.explode("cells").alias("cell")), "id")
            asked = F.broadcast(plan.select(F.explode("cells").alias("cell")).distinct())  # no more than the cells there are
            both = stream_past(parts.join(asked, "cell", "left_semi"), each_lane(asks, "cell", self.lanes), "cell", len(self.cells.filled))
            found = both.mapInArrow(_score(k, same), "query long, w int, id long, score long")
            found = found if best is None else found.unionByName(best)
            best = keep(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place"), "best")
            worst = best.groupBy("query", "w").agg(F.count("*").alias("n"), F.min("score").alias("worst")).where(F.col("n") == k)
            now = (open_.drop("least", "done").join(plan.select(F.col("id").alias("query"), "done", "rest"), "query")
                   .join(worst.select("query", "w", F.col("worst").alias("least")), ["query", "w"], "left"))
            certified = (F.col("rest") < F.col("low")) | F.coalesce(F.col("least") > F.col("rest"), F.lit(False))
            open_ = keep(now.where(~certified & (F.col("rest") > F.lit(float("-inf")))).select("query", "w", "low", "high", "least", "done"),
                         "windows")
            budget *= MORE
        if best is None:
            return self.rows.sparkSession.createDataFrame([], "query long, w int, id long, score long")
        return best


def _floor(x: Column) -> Column:
    return ((x - F.pmod(x, F.lit(100))) / 100).cast("long")


def hard_negatives(rows: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 3,
                   low: int = 50, high: int = 95, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components count as floor(scale * x), a score is the integer inner product with the anchor (exact
    up to 2^53). An anchor is a row for which ``is_anchor`` (over ``id_col``) holds; its positives are
    its first ``positives`` other rows of the same label; for each, the first ``negatives`` rows of
    other labels whose score is from ``low`` to ``high`` percent of the positive's, both included.
    Higher scores come first, equal ones by smaller id. Fewer rows give fewer results; a positive
    without such a row has none, as has one of a negative score.

    Rows without an id or label, and vectors that are null, empty or hold null or non-finite components
    take no part. Vectors of different length never meet. Rows that share an id are no partners of each
    other; where an anchor's id is repeated, the row of the least (label, vector) is the anchor, and a
    row repeated may be named more than once. An empty table gives no rows. Other columns are not read.
    """
    index = MultiIndex(rows, scale, id_col, label, vector_col)
    anchors = index.rows.select(F.col("id").alias(id_col), "label", "vector").where(is_anchor)
    anchors = keep(anchors.groupBy(F.col(id_col).alias("id")).agg(F.min(F.struct("label", "vector")).alias("own"))
                   .select("id", "own.label", "own.vector"), "anchors")
    most = 1 << 62
    whole = anchors.select(F.col("id").alias("query"), F.lit(1).alias("w"), F.lit(-most).alias("low"), F.lit(most).alias("high"))
    near = index.search(anchors, whole, True, positives)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    near = keep(near.select("query", F.row_number().over(order).alias("w"), F.col("id").alias("positive_id"),
                            F.col("score").alias("positive_score"),
                            (-_floor(-low * F.col("score"))).alias("low"), _floor(high * F.col("score")).alias("high")), "positives")
    found = index.search(anchors, near.where("low <= high").select("query", "w", "low", "high"), False, negatives)
    place = Window.partitionBy("query", "w").orderBy(F.desc("score"), "id")
    return (found.join(near, ["query", "w"]).select(
        F.col("query").alias("anchor_id"), "positive_id", F.row_number().over(place).alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score")))
