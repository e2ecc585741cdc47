"""Bounded groups of sorted rows inside a partition, without one Python call into Spark per group."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def dealt(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with equal keys next to each other in one partition."""
    return df.repartition(*keys).sortWithinPartitions(*keys)


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """One record batch for each run of rows with equal (integer) keys."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for first, last in zip(cuts[:-1], cuts[1:]):
            key = tuple(c[first] for c in columns)
            if held and key != held_key:
                yield _joined(held)
                held = []
            held.append(batch.slice(first, last - first))
            held_key = key
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(parts) == 1:
        return parts[0]
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def forest(linked: np.ndarray) -> np.ndarray:
    """For each member of a symmetric link matrix, the first member it is connected with."""
    label = np.arange(len(linked))
    if len(linked) == 2:
        return np.zeros(2, dtype=np.int64) if linked[0, 1] else label
    for i in range(len(linked)):
        found = label[linked[i]]
        if len(found):
            low = min(found.min(), label[i])
            if (found != low).any() or label[i] != low:
                old = np.unique(np.append(found, label[i]))
                label[np.isin(label, old)] = low
    return label
