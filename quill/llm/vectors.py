"""Vectors as exact integers, shared by the vector operators."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def integer_rows(column: pa.Array, scale: float, length: int | None = None, numbers: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, int64 matrix of floor(scale * x)) for each vector length in the
    batch, or for ``length`` alone. Rows that are null, empty, or hold a null or
    non-finite component are left out. A component beyond ``limit`` raises."""
    most = lambda n: limit(n, numbers)
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    for n in (np.unique(sizes[sizes > 0]).tolist() if length is None else [length]):
        at = np.flatnonzero(sizes == n)
        if not len(at):
            continue
        # Nulls inside a vector come out as NaN.
        x = column.take(pa.array(at)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, n)
        good = np.isfinite(x).all(axis=1)
        with np.errstate(over="ignore"):
            x = np.floor(x[good] * scale)
        if len(x) and np.abs(x).max() > most(n):
            raise ValueError(f"a component of {np.abs(x).max():g} is too large for exact 64-bit distances of {n} components")
        if len(x):
            yield at[good], x.astype(np.int64)


def limit(length: int, numbers: int = 1) -> int:
    """The largest component for which squared distances, times ``numbers``, stay below
    2^62 (and components in 32 bits)."""
    return min(2**31 - 1, math.isqrt(2**62 // (numbers * length)) // 2)


def doubles(col: Column | str) -> Column:
    return F.col(col).cast("array<double>") if isinstance(col, str) else col.cast("array<double>")


def sums(partial: DataFrame) -> dict[int, int]:
    """Totals of (slot int, value long) rows; the number of slots is bounded by the
    caller. Partial sums are added as decimals, so no sum overflows."""
    rows = partial.groupBy("slot").agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("value")).collect()
    return {r["slot"]: int(r["value"]) for r in rows}
