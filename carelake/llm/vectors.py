"""Integer vectors: which vectors count, their scaled floors, and list columns
as matrices."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """Whether the list column ``vector`` is there and all its components are finite numbers."""
    every = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(F.col(vector).isNotNull() & every, F.lit(False))


def floors(vector: str, factor: int) -> Column:
    """floor(factor x component) of every component, as array of long."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(factor))).cast("long"))


def matrix(col: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """The lists of a column of array<long> as rows of a matrix, zero where a list ends early."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    sizes = col.value_lengths().to_numpy(zero_copy_only=False)
    flat = col.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dims).all():
        return flat.reshape(len(col), dims).astype(np.int64)
    row = np.repeat(np.arange(len(col)), sizes)
    at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.zeros((len(col), dims), np.int64)
    out[row, at] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of integer matrices, exact: by doubles while no sum can leave
    their 53 bits, by 64-bit integers while none can leave those."""
    top = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if top < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if top < 2**63:
        return a @ b.T
    raise OverflowError("an inner product may not fit 64 bits")
