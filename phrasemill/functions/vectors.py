"""Dense-vector expressions over ``ARRAY<FLOAT|DOUBLE>`` columns, accumulated in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Dot product; null if either vector is null or holds a null."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    """Euclidean length."""
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def unit(v: Column) -> Column:
    """``v`` at length 1; a zero vector stays zero."""
    n = norm(v)
    return F.when(n > 0, F.transform(v, lambda x: x.cast("double") / n)).otherwise(F.transform(v, lambda x: x.cast("double")))


def is_usable(v: Column, dim: int | None = None) -> Column:
    """True for a vector without nulls, NaN or infinities, of non-zero length and, if given, of ``dim`` numbers."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ok = v.isNotNull() & ~bad & (norm(v) > 0)
    return F.coalesce(ok & (F.size(v) == dim) if dim else ok, F.lit(False))
