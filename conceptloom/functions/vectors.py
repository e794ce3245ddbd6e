"""Column functions on vectors held as array<float> or array<double>; all in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column | str, b: Column | str) -> Column:
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def unit(a: Column | str) -> Column:
    """The vector at length 1; one of length 0 stays."""
    n = norm(a)
    return F.transform(_c(a), lambda x: F.when(n > 0, x.cast("double") / n).otherwise(x.cast("double")))


def distance(a: Column | str, b: Column | str) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") - y.cast("double")), F.lit(0.0), lambda s, x: s + x * x))
