"""Probing written parts of an index: a part is held by a task while the rows that ask it stream past."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions
from .runs import boundaries

#: Parts a shuffle partition holds on average at most.
PARTS_A_TASK = 64


def lanes(sizes: DataFrame, key: str, asks: str, total: int, least: int) -> DataFrame:
    """(key, lanes) of the parts that many rows ask: each lane gets a copy of the part.

    A part is listed from 4 * total / partitions asking rows, so at most a quarter of the
    number of partitions is listed, however large the input: it can be broadcast.
    """
    most = max(least, -(-4 * total // partitions(sizes.sparkSession)))
    return F.broadcast(sizes.where(F.col(asks) > most).select(key, F.ceil(F.col(asks) / most).cast("int").alias("lanes")))


def each_lane(df: DataFrame, key: str, few: DataFrame) -> DataFrame:
    """A copy of the rows for every lane of their key."""
    n = F.coalesce("lanes", F.lit(1))
    return df.join(few, key, "left").withColumn("lane", F.explode(F.sequence(F.lit(0), n - 1))).drop("lanes")


def one_lane(df: DataFrame, key: str, few: DataFrame, by: str) -> DataFrame:
    """Every row on the lane of its key that the hash of ``by`` picks."""
    n = F.coalesce("lanes", F.lit(1))
    return df.join(few, key, "left").withColumn("lane", F.pmod(F.xxhash64(by), n).cast("int")).drop("lanes")


def stream_past(parts: DataFrame, asks: DataFrame, key: str, n_parts: int) -> DataFrame:
    """Parts and asking rows of each (key, lane) in one task, the parts first (``kind`` 0).
    Columns that only one side has are null on the other."""
    both = parts.withColumn("kind", F.lit(0)).unionByName(asks.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    n = max(partitions(parts.sparkSession), -(-n_parts // PARTS_A_TASK))
    return both.repartition(n, key, "lane").sortWithinPartitions(key, "lane", "kind")


def held(batches: Iterator[pa.RecordBatch], key: str, load: Callable[[pa.RecordBatch], object]) -> Iterator[tuple[list, pa.RecordBatch]]:
    """(parts held, rows that ask them) out of the rows of ``stream_past``, batch by batch."""
    now, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = boundaries(pa.Table.from_batches([batch]), [key, "lane", "kind"])
        for start, end in zip(cut, np.append(cut[1:], batch.num_rows), strict=True):
            piece = batch.slice(start, end - start)
            at = tuple(piece.column(piece.schema.get_field_index(c))[0].as_py() for c in (key, "lane", "kind"))
            if at[:2] != now:
                now, parts = at[:2], []
            if at[2]:
                yield parts, piece
            else:
                parts.append(load(piece))
