"""Vector arithmetic on array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 if either vector is all zeros."""
    size = norm(a) * norm(b)
    return F.when(size == 0, F.lit(0.0)).otherwise(dot(a, b) / size)


def euclidean(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) ** 2)
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def unit(a: Column) -> Column:
    """``a`` scaled to length 1; a zero vector stays zero."""
    return F.transform(
        F.array(norm(a)),
        lambda size: F.transform(a, lambda x: F.when(size == 0, F.lit(0.0)).otherwise(x.cast("double") / size)),
    )[0]
