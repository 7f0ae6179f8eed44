"""Reading vector tables: valid rows, and Arrow lists as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(col: str) -> Column:
    """Not null and without null or non-finite components."""
    bad = F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.col(col).isNotNull() & ~F.coalesce(bad, F.lit(True))


def matrix(arr: pa.Array | pa.ChunkedArray, kind=np.int64) -> np.ndarray:
    """Rows of an Arrow list column; shorter rows are filled with zeros."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    size = np.diff(arr.offsets.to_numpy())
    width = int(size.max(initial=0))
    out = np.zeros((len(arr), width), kind)
    out[np.arange(width) < size[:, None]] = arr.flatten().to_numpy(zero_copy_only=False)
    return out
