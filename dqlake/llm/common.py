"""Scratch tables, row identities and word hashing shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
#: Whether Spark removes a query's shuffle files when it ends, and not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Words one Python worker remembers at most before it starts afresh.
CACHE_WORDS = 400_000
#: Folders of local sessions that name no shared one, by application.
_LOCAL: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session (tests) without one gets its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = f"file://{tempfile.mkdtemp(prefix='dqlake-llm-')}"
    return _LOCAL[context.applicationId]


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared root and read it back: cuts lineage and
    survives the loss of any executor. The write's shuffle files go when it ends."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_row_id(docs: DataFrame, id_col: str, name: str, *cols: str) -> DataFrame:
    """``docs`` cut to ``cols`` plus a long column ``rid`` that tells rows apart.

    Where the id column holds integers, unique and without nulls, it serves itself; otherwise rows
    are numbered once and written, so that a recomputed task can't number them differently.
    """
    kept = docs.select(*dict.fromkeys([id_col, *cols]))
    if dict(kept.dtypes)[id_col] in ("bigint", "int", "smallint", "tinyint"):
        n, known, distinct = kept.agg(F.count("*"), F.count(id_col), F.count_distinct(id_col)).first()
        if n == known == distinct:
            return kept.withColumn("rid", F.col(id_col).cast("long"))
    return keep(kept.withColumn("rid", F.monotonically_increasing_id()), name)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered up to ``CACHE_WORDS``."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, text: str | None) -> np.ndarray:
        """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of the text, A-Z in lower case."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; a shorter text is one run."""
    if not len(words):
        return words
    size = min(size, len(words))
    h = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        h = mix(h * GOLDEN + words[i:len(words) - size + 1 + i])
    return np.unique(h)


def batch_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the different words ``[^\\x20\\x09-\\x0D]+`` of all texts, A-Z in lower case, for each word its place
    among them, and where each text's words begin (and the end). Each different word of the batch is hashed
    once; nothing is remembered."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    ends, words = split.offsets.to_numpy().astype(np.int64), split.values.dictionary_encode()
    names = words.dictionary.cast(pa.binary())
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, names.to_numpy(zero_copy_only=False)), np.uint64, len(names))
    at, empty = words.indices.to_numpy(), pc.index(names, b"").as_py()
    real = np.ones(len(at), bool) if empty < 0 else at != empty
    before = np.concatenate([[0], np.cumsum(real)])
    return hashes, at[real], before[ends - ends[0]]


def batch_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, as of ``batch_codes``, and where each text's begin (and the end)."""
    hashes, at, starts = batch_codes(texts)
    return hashes[at], starts


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """``shingle_set`` of every text, the words mixed for all texts at once."""
    words, starts = batch_words(texts)
    mixed = np.full(max(0, len(words) - size + 1), size, np.uint64)
    for i in range(size):
        mixed = mix(mixed * GOLDEN + words[i:len(mixed) + i])
    out = []
    for start, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if end - start < size:
            out.append(shingle_set(words[start:end], size))
            continue
        h = np.sort(mixed[start:end - size + 1])
        out.append(h[np.concatenate([[True], h[1:] != h[:-1]])])
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def lists(values: np.ndarray, lengths: list[int] | np.ndarray, kind: pa.DataType | None = None) -> pa.ListArray:
    """An Arrow list column of ``lengths`` over flat values."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut small, so that what is derived from one stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def sized(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut where the texts of a column reach ``most`` bytes; a longer text stands alone."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, end - start)
            start = end


def flat(parts: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)
