"""Toxicity by a counterfactual-regularised linear classifier.

A text is the set of its words and their beginnings, hashed to slots. The weights
minimise the logistic loss over labelled texts plus an absolute-value penalty, which leaves few
weights, plus a penalty on (score - score of the counterfactual)^2: the same text with each
identity term swapped for another of its kind. A weight that speaks for a group and not for an
insult costs there, so neutral mentions of groups do not raise the score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from .common import CACHE_WORDS, lists, slices

SLOTS = 1 << 20
#: Labelled texts of a class that the fit sees at most; smallest hashes of the id first.
SAMPLE = 3000
#: Weights of the absolute-value and of the counterfactual penalty, steps of the fit.
SPARSE, FAIR, STEPS = 4e-4, 2.0, 300
EDGE = "\x00\t\n .,;:!?\"'()[]{}<>«»„“”‘’…|*_-–—/\\#@&%+=~^`"

# Identity terms by kind; within a kind each swaps for the next.
IDENTITY_TERMS = (
    ("man", "woman"), ("men", "women"), ("boy", "girl"), ("male", "female"), ("mann", "frau"), ("hombre", "mujer"), ("homme", "femme"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"), ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christen", "muslime", "juden", "hindus", "buddhisten"), ("cristianos", "musulmanes", "judíos", "budistas"),
    ("chrétiens", "musulmans", "juifs", "bouddhistes"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("black", "white", "asian", "latino", "arab"), ("african", "european", "american", "mexican", "chinese", "indian"),
    ("immigrant", "native", "refugee"), ("immigrants", "natives", "refugees"),
    ("young", "old"), ("blind", "deaf", "disabled"),
)
SWAPS = {t: kind[(i + 1) % len(kind)] for kind in IDENTITY_TERMS for i, t in enumerate(kind)}


def slots_of(word: str) -> list[int]:
    """Slots of a word: itself and its beginnings of four and five letters."""
    found = [zlib.crc32(b"w" + word.encode("utf-8", "surrogatepass")) % SLOTS]
    for n in (4, 5):
        if len(word) > n:
            found.append(zlib.crc32(b"p" + word[:n].encode("utf-8", "surrogatepass")) % SLOTS)
    return found


class WordSlots(dict):
    """Slots of words as they stand in a text, cut to those that ``kept`` allows."""

    def __init__(self, kept: np.ndarray | None = None) -> None:
        self.kept = None if kept is None else frozenset(kept.tolist())

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHE_WORDS:
            self.clear()
        core = word.strip(EDGE)
        found = slots_of(core) if core else []
        self[word] = out = tuple(s for s in found if self.kept is None or s in self.kept)
        return out

    def of(self, words: set[str]) -> set[int]:
        return set().union(*map(self.__getitem__, words)) if words else set()


def _swapped(words: set[str]) -> set[str]:
    return {SWAPS.get(w.strip(EDGE), w) for w in words}


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Label, weight and the slots of a text and of its counterfactual."""
    slots = WordSlots()
    for batch in slices(batches, 500):
        x, y = [], []
        for text in batch.column(1).to_pylist():
            words = set((text or "").lower().split())
            own, other = slots.of(words), _swapped(words)
            x.append(np.array(sorted(own), np.int32))
            y.append(np.array(sorted(slots.of(other)) if other != words else [], np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), lists(np.concatenate(x), [len(v) for v in x]), lists(np.concatenate(y), [len(v) for v in y])],
            ["label", "own", "other"])


class Rows:
    """Sparse 0/1 rows over dense columns, with the two products the fit needs."""

    def __init__(self, rows: list[np.ndarray], columns: int) -> None:
        self.n, self.columns = len(rows), columns
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.col = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col], self.n)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, r[self.row], self.columns)


def fit(own: list[np.ndarray], other: list[np.ndarray], label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Slots, their weights, and the base score; accelerated proximal gradient steps."""
    seen = np.bincount(np.concatenate([*own, np.zeros(0, np.int64)]).astype(np.int64), minlength=SLOTS)
    kept = np.flatnonzero(seen >= 3)
    column = np.full(SLOTS, -1)
    column[kept] = np.arange(len(kept))

    def cut(rows: list[np.ndarray]) -> list[np.ndarray]:
        return [c[c >= 0] for c in (column[r] for r in rows)]

    x = Rows(cut(own), len(kept))
    with_other = [i for i, r in enumerate(other) if len(r)]
    # slots that a swap takes away and brings; the others cancel
    x_own = Rows(cut([np.setdiff1d(own[i], other[i]) for i in with_other]), len(kept))
    x_other = Rows(cut([np.setdiff1d(other[i], own[i]) for i in with_other]), len(kept))
    swapped = np.bincount(x_own.row, minlength=len(with_other)) + np.bincount(x_other.row, minlength=len(with_other))
    part = weight / weight.sum()
    fair = FAIR / max(1, len(with_other))
    w = z = np.zeros(len(kept) + 1)
    # a step by column: rare slots move as fast as frequent ones
    rate = 1 / (0.25 * x.back(part) * 8 + 2 * fair * (x_own.back(swapped) + x_other.back(swapped)) + 2e-4)
    rate = np.append(rate, 0.5)
    t = 1.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x.dot(z[:-1]) + z[-1], -30, 30)))
        r = part * (p - label)
        grad = np.append(x.back(r), r.sum())
        if len(with_other):
            gap = x_own.dot(z[:-1]) - x_other.dot(z[:-1])
            grad[:-1] += 2 * fair * (x_own.back(gap) - x_other.back(gap))
        new = z - rate * grad
        new[:-1] = np.sign(new[:-1]) * np.maximum(0, np.abs(new[:-1]) - rate[:-1] * SPARSE)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        step = (t - 1) / t_new
        if ((z - new) * (new - w)).sum() > 0:  # overshot: start afresh
            t_new, step = 1.0, 0.0
        z, w, t = new + step * (new - w), new, t_new
    used = np.flatnonzero(w[:-1])
    return kept[used], w[:-1][used], float(w[-1])


class Model:
    def __init__(self, slots: np.ndarray, weights: np.ndarray, base: float) -> None:
        self.slots, self.weights, self.base = slots, weights, base

    def scorer(self):
        by_slot = dict(zip(self.slots.tolist(), self.weights.tolist(), strict=True))
        words = WordSlots(self.slots)

        def score(text: str | None) -> float:
            found = words.of(set((text or "").lower().split()))
            # added up in one order, so that a score does not depend on the order of a set
            raw = self.base + sum(by_slot[s] for s in sorted(found))
            return float(1 / (1 + np.exp(-np.clip(raw, -30, 30))))

        return score


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, label_col: str = "toxic", id_col: str = "doc_id",
          sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows of each class among those that ``may_learn`` allows.
    The loss weighs each class by its size among all of them. Labels that are null, and rows whose
    labels contradict each other, do not count. Without rows of both classes the score is a constant."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(id_col)
             .agg(F.min(label_col).alias("label"), F.max(label_col).alias("high")).where("label = high").drop("high")
             .where(may_learn))
    size = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    picks = [known.where(F.col("label") == c).orderBy(F.xxhash64(id_col), id_col).limit(sample) for c in (0, 1)]
    picked = picks[0].unionByName(picks[1])
    texts = docs.select(id_col, "text").where(F.col("text").isNotNull())
    # at most 2 * sample ids, and one text of each, the least, where an id is repeated
    found = texts.join(F.broadcast(picked), id_col).groupBy(id_col, "label").agg(F.min("text").alias("text"))
    rows = (found.orderBy(F.xxhash64(id_col), id_col).select(F.col("label").cast("int").alias("label"), "text")
            .mapInArrow(_sample_rows, "label int, own array<int>, other array<int>").toArrow())
    label = rows.column("label").to_numpy().astype(float)
    own, other = ([v.values.to_numpy() for v in rows.column(k)] for k in ("own", "other"))
    n = np.bincount(label.astype(int), minlength=2)
    if not n.all():
        return Model(np.zeros(0, np.int64), np.zeros(0), -4.0 if not n[1] else 4.0)
    weight = np.where(label == 1, size.get(1, 1) / n[1], size.get(0, 1) / n[0])
    return Model(*fit(own, other, label, weight))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with a last column ``toxicity``, from 0 to 1. Null and empty texts get the base
    score. All columns and rows stay; a column named ``toxicity`` is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most as large as the sample's words
    kept = [c for c in docs.columns if c != "toxicity"]
    at = kept.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer()
        for batch in batches:
            out = [scorer(t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], [*batch.schema.names, "toxicity"])

    cut = docs.select(*kept)
    return cut.mapInArrow(run, StructType([*cut.schema.fields]).add("toxicity", DoubleType()))
