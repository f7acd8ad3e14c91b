"""Arrow and numpy helpers for tables of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """The vector is not NULL and has no NULL and no non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column whose lists have one length, as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))
