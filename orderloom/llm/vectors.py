"""Embedding columns as numpy matrices, batch by batch."""

import numpy as np
import pyarrow as pa


def usable(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row numbers, first entries, lengths) of the vectors that are not null or empty and hold finite entries alone.

    The entries are positions in `values(batch, column)`.
    """
    vectors = batch.column(column)
    offsets = vectors.offsets.to_numpy()
    entries = vectors.values
    finite = np.isfinite(entries.to_numpy(zero_copy_only=False).astype(np.float64))
    wrong = np.concatenate([[0], np.cumsum(~finite | entries.is_null().to_numpy(zero_copy_only=False))])
    starts, ends = offsets[:-1], offsets[1:]
    there = vectors.is_valid().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(there & (ends > starts) & (wrong[ends] == wrong[starts]))
    return rows, starts[rows], (ends - starts)[rows]


def values(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """All entries of a batch as doubles, nulls as NaN."""
    return batch.column(column).values.to_numpy(zero_copy_only=False).astype(np.float64)


def matrix(batch: pa.RecordBatch, column: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and entries of the usable vectors of `width` entries."""
    rows, starts, lengths = usable(batch, column)
    fits = lengths == width
    return rows[fits], values(batch, column)[starts[fits][:, None] + np.arange(width)]


def padded(batch: pa.RecordBatch, column: str, width: int) -> np.ndarray:
    """Every vector of a batch of usable ones, with zeros up to `width` entries."""
    _, starts, lengths = usable(batch, column)
    inside = np.arange(width) < lengths[:, None]
    out = np.zeros(inside.shape)
    out[inside] = values(batch, column)[(starts[:, None] + np.arange(width))[inside]]
    return out


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows divided by their norms, scaled first so that no square leaves the range of a double; zero rows stay."""
    scaled = vectors / np.maximum(np.abs(vectors).max(axis=1, initial=0, keepdims=True), np.finfo(float).tiny)
    norms = np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]
    return np.divide(scaled, norms, out=np.zeros_like(scaled), where=norms > 0)
