"""Removal of lines that many documents share, by a sharded minimal perfect hash.

The distinct line hashes are cut into shards by their leading bits. For each shard one task builds a
minimal perfect hash in levels of bit arrays: a key takes its bit where no other key of the level
falls on it, the rest go on to the next level; the rank of its bit is the key's place in two compact
arrays, fingerprints and numbers of documents. Documents then probe the arrays: their line hashes
stream past the shards, and only those over the threshold come back, as line numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import GOLDEN, keep, mix, partitions, slices, with_row_id
from .probing import each_lane, held, lanes, one_lane, stream_past
from .runs import dealt, sorted_groups

#: What counts as white space at the ends of a line, as bytes.
BLANK = b" \t\n\x0b\x0c\r"
#: Keys of a shard on average at most, bits a key on each level, least rows at which a shard is copied to lanes.
SHARD, ROOM, LANE = 1 << 15, 1.5, 1 << 16


def line_keys(text: bytes | None) -> list[bytes]:
    """The lines of a text, stripped at both ends, A-Z in lower case."""
    return [line.strip(BLANK).lower() for line in (text or b"").split(b"\n")]


def _level(a: np.ndarray, b: np.ndarray, level: int, room: int) -> np.ndarray:
    seed = np.uint64((level + 1) * int(GOLDEN) % (1 << 64))
    return (mix(a ^ mix(b + seed)) % np.uint64(room)).astype(np.int64)


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys, given as two 64-bit arrays."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # words of 64 bits
        self.ranks, before = [], 0
        for words in levels:
            ones = np.bitwise_count(words).astype(np.int64)
            self.ranks.append(before + np.cumsum(ones) - ones)
            before += int(ones.sum())

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> PerfectHash:
        levels: list[np.ndarray] = []
        while len(a):
            words = int(len(a) * ROOM) // 64 + 1
            at = _level(a, b, len(levels), words * 64)
            alone = np.bincount(at, minlength=words * 64) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            rest = ~alone[at]
            a, b = a[rest], b[rest]
        return cls(levels)

    def places(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The place of each key, from 0; -1 for keys that fall on no bit (none of those built in)."""
        out, open_ = np.full(len(a), -1, np.int64), np.arange(len(a))
        for level, (words, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = _level(a[open_], b[open_], level, len(words) * 64)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            here = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word[here]] & ((np.uint64(1) << bit[here]) - np.uint64(1))
            out[open_[here]] = ranks[word[here]] + np.bitwise_count(below)
            open_ = open_[~here]
        return out

    def dump(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], np.uint64)
        return sizes.tobytes() + b"".join(w.tobytes() for w in self.levels)

    @classmethod
    def read(cls, data: bytes) -> PerfectHash:
        words = np.frombuffer(data, np.uint64)
        n = int(words[0])
        ends = n + 1 + np.cumsum(words[1:n + 1].astype(np.int64))
        return cls(np.split(words, [n + 1, *ends])[1:n + 1])


def _fingerprints(b: np.ndarray) -> np.ndarray:
    return mix(b + GOLDEN).astype(np.uint32)


def line_refs(docs: DataFrame, text_col: str = "text", min_chars: int = 1) -> DataFrame:
    """(rid, first, a, b): each distinct key of each row's text once, with the number of the first
    line that has it and its 128-bit hash. Keys of fewer than ``min_chars`` code points are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            rids, firsts, digests, counts = batch.column(0).to_numpy(), [], [], []
            for text in batch.column(1).to_pylist():
                keys: dict[bytes, int] = {}
                for i, key in enumerate(line_keys(text)):
                    keys.setdefault(key, i)
                found = [(i, k) for k, i in keys.items()
                         if len(k) >= min_chars and (min_chars < 2 or len(k.decode()) >= min_chars)]
                firsts.extend(i for i, _ in found)
                digests.extend(xxhash.xxh3_128_digest(k) for _, k in found)
                counts.append(len(found))
            h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(rids, counts)), pa.array(firsts, pa.int32()), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy())],
                ["rid", "first", "a", "b"])

    return docs.select("rid", F.col(text_col).cast("binary")).mapInArrow(run, "rid long, first int, a long, b long")


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, starts in sorted_groups(batches, ["shard"]):
        a, b = (np.ascontiguousarray(table.column(k).to_numpy()).view(np.uint64) for k in ("a", "b"))
        n, shard = table.column("n").to_numpy(), table.column("shard").to_numpy()
        for start, end in zip(starts[:-1], starts[1:], strict=True):
            own = slice(start, end)
            made = PerfectHash.build(a[own], b[own])
            at = made.places(a[own], b[own])
            prints, counts = np.empty(end - start, np.uint32), np.empty(end - start, np.int64)
            prints[at], counts[at] = _fingerprints(b[own]), n[own]
            narrow = counts.astype(np.min_scalar_type(int(counts.max())))
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard[start]], pa.int64()), pa.array([made.dump()], pa.binary()), pa.array([prints.tobytes()], pa.binary()),
                 pa.array([narrow.tobytes()], pa.binary()), pa.array([narrow.itemsize], pa.int32()),
                 pa.array([int(counts.sum())], pa.int64())], ["shard", "hash", "prints", "counts", "width", "refs"])


def shard_of(refs: DataFrame, bits: int) -> DataFrame:
    """The shard of a key is the value of its first ``bits`` bits."""
    return refs.withColumn("shard", F.shiftrightunsigned("a", 64 - bits) if bits else F.lit(0).cast("long"))


def line_index(refs: DataFrame, bits: int) -> DataFrame:
    """One row per shard: its perfect hash and, by place, fingerprints (32 bits) and numbers of
    documents (as wide as the largest needs). Repeats of a key are added up before they meet."""
    counted = shard_of(refs, bits).groupBy("shard", "a", "b").agg(F.count("*").alias("n"))
    return dealt(counted, ["shard"]).mapInArrow(
        _shards, "shard long, hash binary, prints binary, counts binary, width int, refs long")


def _load(piece: pa.RecordBatch) -> tuple[PerfectHash, np.ndarray, np.ndarray]:
    r = piece.select(["hash", "prints", "counts", "width"]).to_pylist()[0]
    return PerfectHash.read(r["hash"]), np.frombuffer(r["prints"], np.uint32), np.frombuffer(r["counts"], f"u{r['width']}")


def probe(refs: DataFrame, index: DataFrame, bits: int, min_docs: int) -> DataFrame:
    """(rid, first) of the refs whose key the index counts in at least ``min_docs`` documents. A key
    the index was not built over passes for another with a chance of 2^-32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts, asks in held(batches, "shard", _load):
            a, b = (asks.column(asks.schema.get_field_index(k)).to_numpy().view(np.uint64) for k in ("a", "b"))
            hit = np.zeros(len(a), bool)
            for made, prints, counts in parts:
                at = made.places(a, b)
                hit |= (at >= 0) & (prints[at] == _fingerprints(b)) & (counts[at] >= min_docs)
            if hit.any():
                yield asks.select(["rid", "first"]).filter(pa.array(hit))

    total = refs.count()
    few = lanes(index, "shard", "refs", total, LANE)
    both = stream_past(each_lane(index.drop("refs"), "shard", few), one_lane(shard_of(refs, bits), "shard", few, "rid"),
                       "shard", 1 << bits)
    return both.mapInArrow(run, "rid long, first int")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1000):
        n_lines, n_dropped, kept = [], [], []
        for text, firsts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            text = text or b""
            if not firsts:
                n_lines.append(text.count(b"\n") + 1), n_dropped.append(0), kept.append(text)
                continue
            keys = line_keys(text)
            common = {keys[i] for i in firsts}
            stay = [line for line, key in zip(text.split(b"\n"), keys, strict=True) if key not in common]
            n_lines.append(len(keys)), n_dropped.append(len(keys) - len(stay)), kept.append(b"\n".join(stay))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
                                          pa.array(kept, pa.binary())], ["rid", "n_lines", "n_dropped", "kept"])


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """(id, n_lines, n_dropped, text): the texts without the lines found in ``min_docs`` documents.

    A line's key is the line without white space at its ends, A-Z in lower case. A key of at least
    ``min_chars`` code points that stands in at least ``min_docs`` documents loses all its lines in
    every document; the other lines stay as they are, joined by a line break. Every row is a document
    and gives a row, also where ids are null or repeated (rows are told apart by numbers of their own)
    and where ids are no integers. A null or empty text is one empty line; its text comes back empty.
    Repeated lines of a document count once towards ``min_docs``. Blank lines have an empty key and
    stay, as ``min_chars`` is at least 1. Very long texts are split in memory one at a time. Columns
    other than id and text are not read, so their names don't matter.
    """
    if min_chars < 1:
        raise ValueError("min_chars must be at least 1")
    spark = docs.sparkSession
    rows = with_row_id(docs, id_col, "line-docs", text_col)
    refs = keep(line_refs(rows, text_col, min_chars), "line-refs")
    shards = max(2 * partitions(spark), refs.count() // SHARD)
    bits = (shards - 1).bit_length()
    index = keep(line_index(refs, bits), "line-index")
    common = probe(refs, index, bits, min_docs).groupBy("rid").agg(F.collect_list("first").alias("firsts"))
    texts = rows.select(F.col("rid"), F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("body"))
    met = texts.join(common, "rid", "left")
    kind = rows.schema[id_col].dataType.simpleString()
    out = met.select("id", "body", "firsts").mapInArrow(_without, f"rid {kind}, n_lines long, n_dropped long, kept binary")
    return out.select(F.col("rid").alias(id_col), "n_lines", "n_dropped", F.col("kept").cast("string").alias(text_col))
