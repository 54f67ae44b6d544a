"""Vectors in Arrow batches as one numpy matrix; shared by the operators that read whole tables of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F


def width(vectors: DataFrame, vector_col: str) -> int:
    """Components of the longest vector (0 without vectors)."""
    return vectors.agg(F.max(F.size(F.col(vector_col)))).first()[0] or 0


def matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold only finite components, and these rows as doubles; a shorter vector ends in zeros."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(int)
    values = pc.fill_null(column.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), dim))
    out[np.arange(dim)[None, :] < sizes[:, None]] = values
    good = column.is_valid().to_numpy(zero_copy_only=False) & np.isfinite(out).all(axis=1)
    return good, out[good]


def binaries(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary())


def from_binaries(blobs, kind: str, dim: int) -> np.ndarray:
    """The matrix that ``binaries`` took apart."""
    return np.frombuffer(b"".join(blobs), kind).reshape(-1, dim)
