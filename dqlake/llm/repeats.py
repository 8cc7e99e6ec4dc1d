"""Removal of long repeated byte strings by suffix arrays.

Comparing all suffixes of a corpus would shuffle every byte many times over, so suffixes are
brought together in three steps. (1) Anchors: of each string of ``length`` bytes the position with the
least hash of ``GRAM`` bytes is its anchor, so that equal strings hold the same anchor at the same
place. An anchor serves a run of starts; each start has one anchor. (2) Starts up to half a string before the
anchor and those further before it make a window each: the bytes from the first of them to the
end of the last one's string. All strings of a window share the bytes next to the anchor; their hash is the window's key.
Windows that are equal as a whole are counted first; they repeat wholly. (3) The different windows of a
key go to one task, which builds two sparse suffix arrays over them: one of what follows the anchors, one of what
stands before them, read backwards. The common prefixes of neighbours in both tell the strings that
are equal on either side of the anchor, and so as a whole.

Keys that very many different windows share are split by longer and longer keys; the last of them
is the whole string, where windows of a key agree by definition and need not meet in a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import flat, keep, mix, slices, with_row_id
from .runs import dealt, sorted_groups

#: Bytes hashed to choose anchors.
GRAM = 32
#: Bytes of a text that are hashed at a time; pieces overlap, so no string is missed.
PIECE = 1 << 19
#: Different windows of a key that one suffix array takes; more are split by longer keys.
CROWD = 512
#: Windows that share a pair of suffix arrays, or up to CROWD more.
BLOCK = 1 << 11
#: The longer keys leave open one of so many parts of the bytes around the gram; None: whole strings.
LONGER = (16, None)

BASES = tuple(np.uint64(b) for b in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
INVERSES = tuple(np.uint64(pow(int(b), -1, 1 << 64)) for b in BASES)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 14), base, np.uint64)
        known[0] = 1
        _POWERS[int(base)] = known = np.multiply.accumulate(known)
    return known[:n]


class Rolling:
    """Hashes of any stretch of a byte array, two bases, in constant time each."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        value = data.astype(np.uint64) + np.uint64(1)
        self.sums, self.back = [], []
        for base, inverse in zip(BASES, INVERSES, strict=True):
            s = np.zeros(n + 1, np.uint64)
            np.cumsum(value * powers(base, n), out=s[1:])
            self.sums.append(s), self.back.append(powers(inverse, n + 1))

    def of(self, start: np.ndarray, end: np.ndarray, i: int = 0) -> np.ndarray:
        return mix((self.sums[i][end] - self.sums[i][start]) * self.back[i][start] + (end - start).astype(np.uint64))


def anchors(roll: Rolling, n: int, length: int) -> np.ndarray:
    """For each string of ``length`` bytes the position in it with the least hash of GRAM bytes (the last
    of equal ones); they rise with the strings."""
    span = length - GRAM + 1
    m = n - GRAM + 1
    at = np.arange(m)
    order = (roll.of(at, at + GRAM) >> np.uint64(20) << np.uint64(20)) | np.uint64((1 << 20) - 1) - at.astype(np.uint64)
    width = -(-m // span) * span
    padded = np.full(width, np.iinfo(np.uint64).max, np.uint64)
    padded[:m] = order
    blocks = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:m - span + 1], ahead[span - 1:m])
    return (np.uint64((1 << 20) - 1) - (least & np.uint64((1 << 20) - 1))).astype(np.int64)


def _anchor_rows(length: int):
    """The windows of each text: anchor, first and last start (relative to it), hash and key."""
    half = (length - GRAM) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            out: list[list[np.ndarray]] = [[] for _ in range(7)]
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                for begin in range(0, max(1, len(raw) - length + 1), PIECE):
                    # the strings that start in this piece
                    data = np.frombuffer(raw, np.uint8)[begin:begin + PIECE + length - 1]
                    if len(data) < length:
                        continue
                    roll = Rolling(data)
                    anchor = anchors(roll, len(data), length)
                    far = anchor - np.arange(len(anchor)) > half
                    lo = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (far[1:] != far[:-1])]))
                    hi = np.append(lo[1:], len(anchor)) - 1
                    a, far = anchor[lo], far[lo]
                    # what all strings of the window hold next to the anchor
                    key = roll.of(np.where(far, a - half - 1, a), np.where(far, a + GRAM, a + length - half))
                    place = mix((a - lo).astype(np.uint64) * np.uint64(2) + far.astype(np.uint64))
                    for o, v in zip(out, (np.full(len(a), rid), a + begin, lo - a, hi - a, roll.of(lo, hi + length) ^ place,
                                          roll.of(lo, hi + length, 1) ^ place, mix(key + far.astype(np.uint64))), strict=True):
                        o.append(v.view(np.int64) if v.dtype == np.uint64 else v)
            yield pa.RecordBatch.from_arrays([pa.array(flat(o, np.int64)) for o in out],
                                             ["rid", "pos", "lo", "hi", "w1", "w2", "key"])

    return run


def _cut_windows(length: int):
    """The bytes of the listed windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            rows = []
            for text, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                rows += [{**x, "low": x["lo"], "bytes": raw[x["pos"] + x["lo"]:x["pos"] + x["hi"] + length]} for x in at]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                [(k, pa.int64()) for k in ("key", "w1", "w2", "low", "lo", "hi")] + [("bytes", pa.binary())]))

    return run


def _longer_keys(length: int, parts: int | None):
    """The starts of each window in runs that leave open the ``parts``-th share of a string: first and last
    of each, and the key of what its strings share (None: one start each, the whole string)."""
    room = length - GRAM
    step = -(-room // parts) if parts else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            out: list[list[np.ndarray]] = [[] for _ in range(6)]
            for w1, w2, low, lo, hi, raw in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                roll = Rolling(np.frombuffer(raw, np.uint8))
                number = np.arange(-hi // step, -lo // step + 1)
                # strings that start here, or up to step - 1 bytes before, hold what lies between begin and stop
                here = -number * step
                start, end = np.maximum(here - step + 1, lo), np.minimum(here, hi)
                begin, stop = here - low, here - step + 1 + length - low
                place = mix(number.astype(np.uint64))
                for o, v in zip(out, (np.full(len(number), w1), np.full(len(number), w2), (roll.of(begin, stop) ^ place).view(np.int64),
                                      (roll.of(begin, stop, 1) ^ place).view(np.int64), start, end), strict=True):
                    o.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(flat(o, np.int64)) for o in out], ["w1", "w2", "key", "key2", "lo", "hi"])

    return run
def _words(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each position, as a number that sorts alike."""
    view = np.lib.stride_tricks.sliding_window_view(text, 8)
    return np.ascontiguousarray(view[at]).view(">u8").ravel().astype(np.uint64)


def suffix_array(text: np.ndarray, depth: int, at: np.ndarray | None = None) -> np.ndarray:
    """The positions ``at`` of ``text`` (all, if None) in the order of the first ``depth`` bytes of
    their suffixes (ties in any order)."""
    raw = text.tobytes()
    at = np.arange(len(text)) if at is None else at
    heads = [raw[i:i + depth] for i in at.tolist()]
    return at[np.array(sorted(range(len(heads)), key=heads.__getitem__), np.int64)]


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it, up to ``depth``."""
    lcp = np.zeros(len(order), np.int64)
    padded = np.concatenate([text, np.zeros(depth + 8, np.uint8)])
    open_ = np.arange(1, len(order))
    for at in range(0, depth, 8):
        differ = _words(padded, order[open_] + at) ^ _words(padded, order[open_ - 1] + at)
        equal = differ == 0
        lcp[open_[equal]] += 8
        rest = open_[~equal]
        bits = np.floor(np.log2(np.maximum(differ[~equal], 1).astype(np.float64))).astype(np.int64)
        lead = 7 - bits // 8
        # the logarithm may round up to the next power of two
        lead = np.where((differ[~equal] >> (np.uint64(64) - 8 * (lead + 1).astype(np.uint64))) == 0, lead + 1, lead)
        lcp[rest] += lead
        open_ = open_[equal]
        if not len(open_):
            break
    return np.minimum(lcp, depth)


def repeated_starts(windows: list[bytes], group: np.ndarray, low: np.ndarray, lo: np.ndarray, hi: np.ndarray,
                    length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, first, last): runs of starts whose strings of ``length`` bytes other windows of the group hold at the
    same distance from the anchor. ``group`` rises; ``low``: the window's first byte, ``lo`` to ``hi``: the
    starts looked at, all counted from the anchor."""
    k = len(windows)
    sizes = np.array([len(w) for w in windows])
    text = np.frombuffer(b"".join(windows), np.uint8)
    owner = np.repeat(np.arange(k), sizes)
    anchor = np.cumsum(sizes) - sizes - low
    heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    base = np.repeat(np.minimum.reduceat(lo, heads), np.diff(np.append(heads, k)))
    start = base + np.arange(int((hi - base).max()) + 1)[:, None]

    def classes(text: np.ndarray, order: np.ndarray, rows: np.ndarray, need: np.ndarray) -> np.ndarray:
        """Numbers that windows of a group share where they agree in the bytes needed from a start on."""
        by = np.argsort(group[rows], kind="stable")
        order, rows = order[by], rows[by]
        common = common_prefixes(text, order, length)
        common[heads] = -1
        out = np.empty(need.shape, np.int64)
        out[:, rows] = np.cumsum(common < need[:, rows], axis=1)
        return out

    after = suffix_array(text, length, anchor)
    before = suffix_array(text[::-1], length, len(text) - anchor)
    both = (classes(text, after, owner[after], start + length) * (k + 1)
            + classes(text[::-1], before, owner[len(text) - before], -start))
    # windows without a start stand alone there
    both = np.where((start >= lo) & (start <= hi), both, (k + 1) ** 2 + np.arange(k))
    bits = k.bit_length()
    both = np.sort(both << bits | np.arange(k), axis=1)
    same = (both[:, 1:] >> bits) == (both[:, :-1] >> bits)
    found = np.zeros((k, len(start) + 2), np.int8)
    for one in (both[:, 1:], both[:, :-1]):
        at, place = np.nonzero(same)
        found[one[at, place] & ((1 << bits) - 1), at + 1] = 1
    edge = np.diff(found, axis=1)
    window, first = np.nonzero(edge == 1)
    return window, base[window] + first, base[window] + np.nonzero(edge == -1)[1] - 1


def _match(length: int):
    """Suffix arrays over the windows of keys; yields runs of repeated starts, counted from the anchor."""
    numbers = ["w1", "w2", "low", "lo", "hi"]

    def emit(tables: list[pa.Table]) -> pa.RecordBatch:
        block = pa.concat_tables(tables).combine_chunks()
        w1, w2, low, lo, hi = (block.column(c).to_numpy() for c in numbers)
        group = np.repeat(np.arange(len(tables)), [t.num_rows for t in tables])
        window, first, last = repeated_starts(block.column("bytes").to_pylist(), group, low, lo, hi, length)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (w1[window], w2[window], first, last)], ["w1", "w2", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = [], 0
        for table, starts in sorted_groups(slices(batches, 500), ["key"]):
            for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                block.append(table.slice(lo, hi - lo))
                size += hi - lo
                if size >= BLOCK:
                    yield emit(block)
                    block, size = [], 0
        if block:
            yield emit(block)

    return run


def _removed(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            out = []
            for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                merged: list[list[int]] = []
                for x in sorted(runs or [], key=lambda x: (x["low"], x["high"])):
                    a, b = max(0, x["low"]), min(len(raw), x["high"] + length)
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                digest, at = hashlib.sha256(), 0
                for a, b in merged:
                    digest.update(raw[at:a])
                    at = b
                digest.update(raw[at:])
                out.append((len(raw), sum(b - a for a, b in merged), len(merged), digest.hexdigest(),
                            [{"start": a, "end": b} for a, b in merged]))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), span]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)],
                ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])

    return run


def repeated_spans(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id_col, n_bytes, n_removed, n_spans, kept_sha256 and ``removed``, the spans
    (start, end) in UTF-8 bytes that strings of ``length`` bytes found elsewhere too cover.

    Elsewhere is any other place of any row, the same text included; overlaps count. A null text is
    empty. Repeated rows and rows with equal or null ids count as rows of their own. Shorter texts
    keep everything. Other columns are not read. An empty table gives an empty result.
    """
    rows = with_row_id(docs, id_col, "rows", text_col).select("rid", F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marks = keep(rows.select("rid", "text").mapInArrow(
        _anchor_rows(length), "rid long, pos long, lo long, hi long, w1 long, w2 long, key long"), "anchors")

    # equal windows are counted before anything is shuffled
    by_window = (marks.groupBy("key", "w1", "w2")
                 .agg(F.count("*").alias("c"), F.min(F.struct("rid", "pos", "lo", "hi")).alias("one")))
    counted = by_window.groupBy("key").agg(F.sum("c").alias("total"), F.count("*").alias("kinds")).where("total > 1")
    under = keep(by_window.join(counted, "key"), "windows")
    # what occurs twice as a whole repeats wholly
    found = [under.where("c > 1").select("w1", "w2", F.col("one.lo").alias("low"), F.col("one.hi").alias("high"))]

    def cut(wanted: DataFrame) -> DataFrame:
        at = F.collect_list(F.struct("key", "w1", "w2", "one.pos", "one.lo", "one.hi")).alias("at")
        return (rows.select("rid", "text").join(wanted.groupBy(F.col("one.rid").alias("rid")).agg(at), "rid").select("text", "at")
                .mapInArrow(_cut_windows(length), "key long, w1 long, w2 long, low long, lo long, hi long, bytes binary"))

    parts = [cut(under.where(f"kinds > 1 and kinds <= {CROWD}"))]
    crowd = under.where(f"kinds > {CROWD}")
    if not crowd.isEmpty():
        windows = keep(cut(crowd), "bytes").drop("key")
        runs = windows.select("w1", "w2", "lo", "hi")
        held = windows.drop("lo", "hi")
        for level in LONGER:
            longer = keep(held.join(runs, ["w1", "w2"]).select("w1", "w2", "low", "lo", "hi", "bytes").mapInArrow(
                _longer_keys(length, level), "w1 long, w2 long, key long, key2 long, lo long, hi long"), "longer")
            sized = longer.join(longer.groupBy("key", "key2").agg(F.count("*").alias("kinds")).where("kinds > 1"), ["key", "key2"])
            if level is None:
                found.append(sized.select("w1", "w2", F.col("lo").alias("low"), F.col("hi").alias("high")))
                break
            parts.append(held.join(sized.where(f"kinds <= {CROWD}").select("key", "w1", "w2", "lo", "hi"), ["w1", "w2"]))
            runs = keep(sized.where(f"kinds > {CROWD}").select("w1", "w2", "lo", "hi"), "crowd")
            if runs.isEmpty():
                break
    for part in parts:
        found.append(dealt(part.select("key", "w1", "w2", "low", "lo", "hi", "bytes"), ["key"]).mapInArrow(
            _match(length), "w1 long, w2 long, low long, high long"))
    some = found[0]
    for f in found[1:]:
        some = some.unionByName(f)
    hits = some.groupBy("w1", "w2").agg(F.collect_list(F.struct("low", "high")).alias("runs"))
    return _finish(rows, marks, hits, length).withColumnRenamed("id", id_col)


def _finish(rows: DataFrame, marks: DataFrame, hits: DataFrame, length: int) -> DataFrame:
    """Carry the repeats of windows to every row that holds them, and take them out."""
    runs = (marks.select("rid", "pos", "w1", "w2").join(hits, ["w1", "w2"]).select("rid", "pos", F.explode("runs").alias("r"))
            .select("rid", (F.col("pos") + F.col("r.low")).alias("low"), (F.col("pos") + F.col("r.high")).alias("high")))
    per_row = runs.groupBy("rid").agg(F.collect_list(F.struct("low", "high")).alias("runs"))
    return (rows.join(per_row, "rid", "left").select("id", "text", "runs")
            .mapInArrow(_removed(length),
                        f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, "
                        "kept_sha256 string, removed array<struct<start: long, end: long>>"))
