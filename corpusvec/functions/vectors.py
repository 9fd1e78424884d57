"""Vector arithmetic on ARRAY columns, summed in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusvec.functions.text import bind


def to_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def to_float32(vector: Column) -> Column:
    """The stored form: single precision."""
    return vector.cast("array<float>")


def inner_product(a: Column, b: Column) -> Column:
    products = F.zip_with(to_double(a), to_double(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2_norm(vector: Column) -> Column:
    return F.sqrt(
        F.aggregate(to_double(vector), F.lit(0.0), lambda total, x: total + x * x)
    )


def l2_normalize(vector: Column) -> Column:
    """Unit length; a zero vector stays as it is."""

    def scaled(x: Column, norm: Column) -> Column:
        return F.when(norm == 0, x).otherwise(F.transform(x, lambda y: y / norm))

    # Vector and norm are each evaluated once, whatever the dimension.
    return bind(to_double(vector), lambda x: bind(l2_norm(x), lambda norm: scaled(x, norm)))


def cosine(a: Column, b: Column) -> Column:
    """Zero if either vector is zero."""
    norms = l2_norm(a) * l2_norm(b)
    return F.when(norms == 0, F.lit(0.0)).otherwise(inner_product(a, b) / norms)
