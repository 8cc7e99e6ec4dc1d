"""Hard negatives against brute force: pruning, ties, lanes, odd vectors."""

import numpy as np
import pytest

from dqlake.llm import hard_negatives as hn
from dqlake.llm.hard_negatives import Cells, Codebooks, MultiIndex, hard_negatives
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, query long, cell string"


def whole(v):
    if v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v):
        return None
    return np.floor(256 * np.array(v, np.float32).astype(np.float64))


def brute(rows, each=5):
    live = [(i, lab, whole(v)) for i, v, lab, *_ in rows if i is not None and lab is not None and whole(v) is not None]
    out = []
    for a, lab, q in live:
        if a % each:
            continue
        scored = sorted((-int(q @ v), i, other) for i, other, v in live if i != a and len(v) == len(q))
        for p, i, _ in [s for s in scored if s[2] == lab][:5]:
            near = [s for s in scored if s[2] != lab and 50 * -p <= 100 * -s[0] <= 95 * -p][:3]
            out += [(a, i, r + 1, s[1], -p, -s[0]) for r, s in enumerate(near)]
    return sorted(out)


def got(df, each=5):
    return sorted(tuple(r) for r in hard_negatives(df, F.col("vec_id") % each == 0).collect())


def made(n, dim, seed, spread=0.3, kinds=4):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(kinds * 2, dim))
    return [(i, [float(x) for x in np.float32(centres[i % len(centres)] + spread * r.normal(size=dim))], i % kinds, 1, "c") for i in range(n)]


@pytest.mark.parametrize("spread", [0.02, 0.3, 2.0])
def test_against_brute_force(spark, monkeypatch, spread):
    """Few rows a round, so that windows take several, with and without clusters that prune."""
    monkeypatch.setattr(hn, "FIRST", 8)
    monkeypatch.setattr(hn, "CELL", 4)
    rows = made(240, 6, 3, spread)
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert want and got(df) == want


def test_ties_lanes_and_blocks(spark, monkeypatch):
    """A third of all rows equal, cells dealt to lanes, few scores at once."""
    monkeypatch.setattr(hn, "LANE", 64)
    monkeypatch.setattr(hn, "SCORES", 40)
    rows = [(i, r[1] if i % 3 else [1.0, 0.5, 0.25, 0.0], r[2], 1, "c") for i, r in enumerate(made(150, 4, 5, 0.4))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(rows)
    assert want and got(df) == want


def test_odd_input(spark):
    """What takes no part, single components, vectors of other lengths, a label alone; no rows."""
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0], 1), (1, [1.0, 0.9], 1), (2, [0.7, 0.7], 2), (3, None, 1), (4, [1.0, None], 2), (5, [1.0, nan], 2),
            (6, [inf, 1.0], 2), (7, [], 1), (8, [0.6, 0.7], None), (None, [0.6, 0.6], 2), (10, [3.0], 1), (11, [2.0], 1),
            (12, [1.5], 2), (15, [-1.0, -1.0], 3), (20, [9.0, 9.0, 9.0], 1), (25, [0.0, 0.0], 2)]
    rows = [(*r, 1, "c") for r in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df) == brute(rows) != []
    assert got(df.limit(0)) == []
    # a repeated anchor counts once, by its least (label, vector)
    again = spark.createDataFrame([(0, [1.0, 1.0], 1, 1, "c"), (0, [1.0, 1.0], 1, 1, "c"), (1, [1.0, 1.0], 1, 1, "c"), (2, [0.7, 0.7], 2, 1, "c")], SCHEMA)
    assert [tuple(r) for r in hard_negatives(again, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 2, 131072, 91648)]


def test_heap_gives_bounds_in_order_that_hold():
    r = np.random.default_rng(2)
    rows = np.floor(256 * r.normal(size=(400, 6)))
    books = Codebooks(list(rows[:200]), 5)
    cell, far_1, far_2 = books.assign(rows)
    seen = [type("R", (), {"cell": int(c), "n": int((cell == c).sum()), "far_1": far_1[cell == c].max(), "far_2": far_2[cell == c].max()})
            for c in np.unique(cell)]
    visits = list(Cells(books, seen).visit(rows[0]))
    assert sorted(v[2] for v in visits) == sorted(np.unique(cell).tolist())
    assert [v[0] for v in visits] == sorted((v[0] for v in visits), reverse=True)
    for upper, lower, c in visits:
        scores = rows[cell == c] @ rows[0]
        assert lower <= scores.min() and scores.max() <= upper


def test_certified_windows_leave_cells_unread(spark, monkeypatch):
    """Far clusters are never asked for: the search ends after the cells that can matter."""
    monkeypatch.setattr(hn, "FIRST", 1)
    monkeypatch.setattr(hn, "MORE", 1)
    monkeypatch.setattr(hn, "CELL", 4)
    rows = made(300, 8, 9, 0.01, 8)
    index = MultiIndex(spark.createDataFrame(rows, SCHEMA))
    asked = []
    real = hn._plan
    monkeypatch.setattr(hn, "_plan", lambda cells, budget: asked.append(budget) or real(cells, budget))
    one = index.rows.where("id = 0").select("id", "label", "vector")
    index.search(one, one.selectExpr("id AS query", "1 AS w", f"-{1 << 60} AS low", f"{1 << 60} AS high"), True, 5)
    assert len(asked) < len(index.cells.filled)
