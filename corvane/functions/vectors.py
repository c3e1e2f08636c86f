"""Arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)),
        F.lit(0.0),
        lambda acc, d: acc + d,
    )


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(squared_distance(a, b))


def flattened(matrix: Column) -> Column:
    """One long vector from a vector of rows."""
    return F.flatten(matrix)


def width(v: Column) -> Column:
    return F.size(v)


def literal_vector(values) -> Column:
    return F.array(*[F.lit(float(x)) for x in values])
