"""Misra–Gries summaries of integer items, one per task: at most ``capacity`` counters and an error bound.

A counter never exceeds its item's count and falls short of it by at most the error; an item without a counter has a
count of at most the error.  Every cut lowers all counters by the same amount, the (capacity + 1)-th largest, so the error
is at most rows / (capacity + 1).  Summaries add up: counters of one item are summed, and errors are summed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SUMMARY_SCHEMA = "item BIGINT, low BIGINT, err BIGINT"


def _add(items: np.ndarray, low: np.ndarray, more: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both, where = np.unique(np.concatenate([items, more]), return_inverse=True)
    total = np.zeros(len(both), np.int64)
    np.add.at(total, where, np.concatenate([low, n]))
    return both, total


def _cut(items: np.ndarray, low: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    if len(items) <= capacity:
        return items, low, 0
    drop = int(np.partition(low, len(low) - capacity - 1)[len(low) - capacity - 1])
    left = low > drop
    return items[left], low[left] - drop, drop


def summary_kernel(capacity: int):
    """``mapInArrow`` function over ``(item BIGINT)`` without nulls: the task's counters, and one row (NULL, 0, error)."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, low, err = np.empty(0, np.int64), np.empty(0, np.int64), 0
        for b in batches:
            more, n = np.unique(b.column(0).to_numpy(zero_copy_only=False), return_counts=True)
            items, low, lost = _cut(*_add(items, low, more, n), capacity)
            err += lost
        columns = [
            pa.array([*items.tolist(), None], pa.int64()),
            pa.array(np.append(low, 0), pa.int64()),
            pa.array(np.append(np.zeros(len(low), np.int64), err), pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["item", "low", "err"])

    return kernel
