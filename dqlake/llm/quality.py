"""Quality classifier from weak labels.

Ten overlapping heuristic labellers vote good, poor or nothing on every text. Expectation-maximisation
over the counts of vote patterns, of which there is a fixed number, estimates how accurate each
labeller is, without any labels; the posterior of a text's pattern is its label. A hashed linear
scorer learns the posteriors from the texts' words and shape, so that it also ranks texts with the
same votes.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from .common import CACHE_WORDS, lists, slices

SLOTS = 1 << 16
#: Texts from which the scorer learns at most, smallest hashes first.
SAMPLE = 6000
#: Passes over the sample, and the weight of the squared penalty.
PASSES, SHRINK = 30, 1e-4
KEEP = 0.5

# Frequent function words of the languages at hand.
FUNCTION_WORDS = frozenset(
    "the of and to in is that for on with was be by it as are this at from or an der die und in den von zu das mit sich des auf für ist im "
    "dem nicht ein eine als de la le les et des en un une du est que pour dans par sur au plus el los las que y del se por con una su para".split())
LABELLERS = ("length", "distinct", "shouting", "symbols", "word_length", "lines", "ending", "run", "function_words", "letters")


def measures(text: str | None) -> tuple[float, ...]:
    """What the labellers look at."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return (0,) * len(LABELLERS)
    chars = sum(map(len, words))
    low = [w.lower().strip(".,;:!?") for w in words]
    run = longest = 1
    for a, b in zip(low, low[1:]):
        run = run + 1 if a == b else 1
        longest = max(longest, run)
    rows = [x for x in text.split("\n") if x.strip()]
    letters = sum(map(str.isalpha, text))
    ends = sum(x.rstrip()[-1] in ".!?…\"»”" for x in rows)
    # of a text of many words only as many as of a short one can differ
    return (n, len(set(low)) / n ** 0.9, sum(map(str.isupper, text)) / max(1, letters), sum(text.count(c) for c in "|{}<>#=!_~^*@\\") / chars,
            chars / n, len(set(rows)) / len(rows), ends / len(rows), longest, sum(w in FUNCTION_WORDS for w in low) / n, letters / chars)


#: (poor below, good from, good to, poor above) for each labeller; between them it does not vote.
BOUNDS = ((12, 40, 50_000, math.inf), (0.35, 0.55, math.inf, math.inf), (-1, 0, 0.12, 0.3), (-1, 0, 0.01, 0.03), (2.0, 3.0, 9.0, 14.0),
          (0.6, 0.9, 1, math.inf), (0.3, 0.8, 1, math.inf), (-1, 1, 2, 3.5), (0.02, 0.08, 1, math.inf), (0.7, 0.85, 1, math.inf))


def votes(text: str | None) -> list[int]:
    """2 good, 0 poor, 1 no vote, per labeller. A text without words is poor to all."""
    return votes_on(measures(text))


def votes_on(m: tuple[float, ...]) -> list[int]:
    return [0 if not m[0] or x < low or x > high else 2 if a <= x <= b else 1 for x, (low, a, b, high) in zip(m, BOUNDS, strict=True)]


def pattern(v: list[int]) -> int:
    return sum(x * 3 ** i for i, x in enumerate(v))


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, n: int, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of 'good' by pattern, P(vote | class) as [class, labeller, vote], share of good."""
    vote = (patterns[:, None] // 3 ** np.arange(n)) % 3
    post = np.clip(0.5 + (vote - 1).sum(1) / (2.0 * n) + 0.2, 0.02, 0.98)  # more often good than not
    table, share = np.zeros((2, n, 3)), 0.5
    for _ in range(rounds):
        for c, w in ((0, counts * (1 - post)), (1, counts * post)):
            for i in range(n):
                t = np.bincount(vote[:, i], w, 3) + 0.5
                table[c, i] = t / t.sum()
        share = float((counts * post).sum() / max(counts.sum(), 1))
        share = min(max(share, 1e-3), 1 - 1e-3)
        logs = np.log(table)
        gap = math.log(share / (1 - share)) + sum(logs[1, i, vote[:, i]] - logs[0, i, vote[:, i]] for i in range(n))
        new = 1 / (1 + np.exp(-np.clip(gap, -30, 30)))
        if np.abs(new - post).max(initial=0) < 1e-6:
            break
        post = new
    # 'good' is the class that labellers call good more often
    if (table[1, :, 2] - table[0, :, 2]).sum() < 0:
        return 1 - post, table[::-1], 1 - share
    return post, table, share


class Features(dict):
    """Slots of words, remembered; a text also has slots for the size of each measure and each vote."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = s = zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % SLOTS
        return s

    def of(self, text: str | None) -> tuple[list[int], list[int]]:
        m = measures(text)
        v = votes_on(m)
        shape = [self[f"\0{i} {int(4 * math.log2(x + 1 / 64))}"] for i, x in enumerate(m)] + [self[f"\0v{i} {x}"] for i, x in enumerate(v)]
        return v, sorted({*map(self.__getitem__, set((text or "").split()))}) + sorted(set(shape) - {None})


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        p, n = np.unique(np.array([pattern(votes(t)) for t in batch.column(0).to_pylist()], np.int64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(n)], ["pattern", "n"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    f = Features()
    for batch in slices(batches, 500):
        both = [f.of(t) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([pattern(v) for v, _ in both], pa.int64()),
             lists(np.concatenate([np.array(x, np.int32) for _, x in both]), [len(x) for _, x in both]), batch.column(1)],
            ["pattern", "slots", "copies"])


class Scorer:
    """Votes' posterior and the linear score of a text."""

    def __init__(self, posterior: dict[int, float], weights: np.ndarray, base: float) -> None:
        self.posterior, self.weights, self.base = posterior, weights, base

    def of(self, features: Features, text: str | None) -> tuple[float, float]:
        v, slots = features.of(text)
        raw = self.base + float(self.weights[slots].sum()) / math.sqrt(len(slots))
        return self.posterior.get(pattern(v), 0.5), 1 / (1 + math.exp(-min(30.0, max(-30.0, raw))))


def train(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> Scorer:
    """Accuracies from the votes on all texts; the linear scorer from at most ``sample`` different texts,
    each with the weight of its copies. Which texts is settled by their hashes alone, so that no task has
    to hold more than its own of them."""
    texts = docs.select(text_col)
    counted = texts.mapInArrow(_patterns, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).toArrow()
    seen, n = (counted.column(k).to_numpy() for k in ("pattern", "n"))
    post, _, share = expectation_maximisation(seen, n.astype(float), len(LABELLERS))
    posterior = dict(zip(seen.tolist(), post.tolist(), strict=True))
    hashed = texts.withColumn("h", F.xxhash64(text_col))
    least = hashed.select("h").distinct().orderBy("h").limit(sample).toArrow()
    bound = max(least.column("h").to_pylist(), default=None)
    # one text of each hash up to the bound: at most ``sample``, and copies leave their task once
    picked = hashed.where(F.col("h") <= F.lit(bound)).groupBy("h").agg(F.first(text_col).alias("text"), F.count("*").alias("copies"))
    rows = picked.orderBy("h").select("text", "copies").mapInArrow(_features, "pattern long, slots array<int>, copies long").toArrow()
    x = [v.values.to_numpy() for v in rows.column("slots")]
    y = np.array([posterior[p] for p in rows.column("pattern").to_pylist()])
    many = rows.column("copies").to_numpy().astype(float)
    many /= many.mean() if len(many) else 1
    weights, base = np.zeros(SLOTS), math.log(share / (1 - share)) if len(x) else 0.0
    size = np.full(SLOTS, 1e-2)
    scale = [1 / math.sqrt(len(r)) for r in x]
    rng = np.random.default_rng(0)
    for _ in range(PASSES if len(x) else 0):
        for i in rng.permutation(len(x)):
            r = x[i]
            p = 1 / (1 + math.exp(-min(30.0, max(-30.0, base + weights[r].sum() * scale[i]))))
            g = many[i] * (p - y[i]) * scale[i]
            step = g + SHRINK * weights[r]
            size[r] += step * step
            weights[r] -= 0.5 * step / np.sqrt(size[r])
            base -= 0.01 * min(many[i], 1.0) * (p - y[i])
    return Scorer(posterior, weights, base)


def score(docs: DataFrame, scorer: Scorer, keep: float = KEEP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, posterior, score, keep) for each row of ``docs``.

    ``posterior`` is the weak label, ``score`` the linear score, both from 0 (poor) to 1; ``keep`` is
    score >= the bound. Null, empty and blank texts are poor by all labellers. Repeated rows and null
    ids are scored like any other row. Extra columns are not read. An empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(scorer)  # SLOTS weights and at most 3 ** 10 patterns
    cut = docs.select(id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in slices(batches):
            out = [sent.value.of(features, t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([o[i] for o in out], pa.float64()) for i in (0, 1))],
                                             [id_col, "posterior", "score"])

    schema = StructType([cut.schema.fields[0]]).add("posterior", DoubleType()).add("score", DoubleType())
    return cut.mapInArrow(run, schema).withColumn("keep", F.col("score") >= keep)
