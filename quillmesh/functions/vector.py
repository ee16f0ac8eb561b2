"""Vector functions over arrays, computed in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _doubles(v: Column | str) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column | str) -> Column:
    return F.sqrt(dot(v, v))


def unit(v: Column | str) -> Column:
    """The vector at length one; a zero vector stays."""
    return F.when(norm(v) > 0, F.transform(v, lambda x: x.cast("double") / norm(v))).otherwise(_doubles(v))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; 0 if a vector has no length."""
    length = norm(a) * norm(b)
    return F.when(length > 0, dot(a, b) / length).otherwise(0.0)


def sigmoid(x: Column | str) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col(x) if isinstance(x, str) else x)))
