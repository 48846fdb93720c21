"""Runs of equal keys in a sorted stream of Arrow batches, in bounded memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def run_edges(keys: np.ndarray) -> np.ndarray:
    """Offsets at which a new run of equal keys begins, and the end."""
    if not len(keys):
        return np.zeros(1, dtype=np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def whole_runs(batches: Iterator[pa.RecordBatch], key: str, value: str, cap: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks (keys, values, long) of complete runs; ``long`` marks the rows of
    runs with more than ``cap`` rows, which may come in several chunks."""
    keys = values = np.zeros(0, dtype=np.int64)
    open_long = None  # key of a long run whose first rows went out already
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.concatenate([keys, column(batch, key)])
        values = np.concatenate([values, column(batch, value)])
        edges = run_edges(keys)
        cut = int(edges[-2])
        if len(keys) - cut > cap or (open_long is not None and keys[cut] == open_long):
            cut = len(keys)
        if cut:
            yield _marked(keys[:cut], values[:cut], cap, open_long)
            open_long = keys[-1] if cut == len(keys) else None
        keys, values = keys[cut:], values[cut:]
    if len(keys):
        yield _marked(keys, values, cap, open_long)


def _marked(keys, values, cap, open_long):
    edges = run_edges(keys)
    long = np.repeat(np.diff(edges) > cap, np.diff(edges))
    if open_long is not None:
        long |= keys == open_long
    return keys, values, long
