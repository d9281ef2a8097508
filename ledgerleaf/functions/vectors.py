"""Vector arithmetic on array columns, in double precision, inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine_similarity(a: Column, b: Column) -> Column:
    """Null when either vector is null or all zero, or when the widths differ."""
    same_width = F.size(a) == F.size(b)
    return F.when(same_width, F.try_divide(dot(a, b), norm(a) * norm(b)))
