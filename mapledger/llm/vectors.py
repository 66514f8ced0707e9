"""Embedding columns as numpy matrices inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Lengths are padded with zeros to a multiple of this, so short vectors have enough directions too.
WIDTH = 64


def usable(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each vector length: vectors that are neither null nor zero and all finite."""
    lengths = np.array([-1 if n is None else n for n in column.value_lengths().to_pylist()], np.int64)
    offsets = np.asarray(column.offsets)[:-1].astype(np.int64) if len(column) else np.zeros(0, np.int64)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    for length in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == length)
        matrix = values[offsets[rows][:, None] + np.arange(length)]
        good = np.isfinite(matrix).all(axis=1) & (matrix != 0).any(axis=1)
        if good.any():
            yield rows[good], matrix[good]


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; first by their largest component, so extreme values neither vanish nor overflow."""
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def padded(matrix: np.ndarray) -> np.ndarray:
    wide = -(-matrix.shape[1] // WIDTH) * WIDTH
    return np.pad(matrix, ((0, 0), (0, wide - matrix.shape[1])))
