"""Vectors of Arrow list columns as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of doubles) for each length of vector; null and empty vectors are left out, null components are NaN."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(lengths) - lengths
    for d in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == d)
        yield rows, values[starts[rows][:, None] + np.arange(d)]


def unpacked(column: pa.Array, dtype: str) -> np.ndarray:
    """A column of equally long binaries as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)
