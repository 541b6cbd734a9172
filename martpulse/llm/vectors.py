"""What the operators on vectors share: sound rows, whole numbers and blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT = 1 << 53  # whole numbers below this are exact as doubles, and so are their sums


def sound(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector is there and holds finite components only."""
    def finite(x: Column) -> Column:
        wide = x.cast("double")
        return wide.isNotNull() & ~F.isnan(wide) & (F.abs(wide) < float("inf"))

    return vectors.where(F.col(column).isNotNull() & F.forall(column, finite))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """floor(256 * x) of a list column as whole doubles, shorter vectors filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lengths), width))
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, place] = np.floor(flat * 256)
    return out


def whole(numbers: np.ndarray, bound: float) -> np.ndarray:
    """``numbers`` as they are if results up to ``bound`` stay exact, else as Python's integers."""
    if bound < EXACT:
        return numbers
    out = np.empty(numbers.shape, object)
    out.flat = [int(x) for x in numbers.flat]
    return out
