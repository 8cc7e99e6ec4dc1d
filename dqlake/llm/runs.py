"""Streaming over sorted rows inside a task: whole groups, whatever batch they came in."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with their start rows (and the end); the rows come sorted by ``keys``."""
    carry: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        first = tuple(batch.column(batch.schema.get_field_index(k))[0] for k in keys)
        end = tuple(batch.column(batch.schema.get_field_index(k))[-1] for k in keys)
        if carry and first == last == end:
            carry.append(batch)
            continue
        table = pa.Table.from_batches([*carry, batch]).combine_chunks()
        starts = boundaries(table, keys)
        if starts[-1]:
            yield table.slice(0, starts[-1]), starts
        carry, last = table.slice(starts[-1]).to_batches(), end
    if carry:
        table = pa.Table.from_batches(carry).combine_chunks()
        starts = boundaries(table, keys)
        yield table, np.append(starts, table.num_rows)


def boundaries(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in keys:
        v = table.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def dealt(df: DataFrame, keys: list[str], order: list[str] = ()) -> DataFrame:
    """Rows of a key together and in order within a partition."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *order)
