"""Vector expressions on ``array<float|double>`` columns (JVM side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double_array(c) -> Column:
    return _col(c).cast("array<double>")


def dot(a, b) -> Column:
    prods = F.zip_with(as_double_array(a), as_double_array(b), lambda x, y: x * y)
    return F.aggregate(prods, F.lit(0.0), lambda acc, v: acc + v)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(as_double_array(a), F.lit(0.0), lambda acc, v: acc + v * v))


def cosine(a, b) -> Column:
    """Cosine similarity (F12). Zero-norm vectors give null, mixed dims raise."""
    checked = F.when(F.size(_col(a)) == F.size(_col(b)), dot(a, b)).otherwise(
        F.raise_error(F.lit("embedding dimensions differ")))
    return F.try_divide(checked, F.nullif(norm(a) * norm(b), F.lit(0.0)))
