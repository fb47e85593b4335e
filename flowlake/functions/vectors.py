"""Arithmetic on ARRAY<DOUBLE> columns, without unnesting and without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def dot(left: Column, right: Column) -> Column:
    """Sum of products; a pair with a NULL side adds nothing."""
    products = F.zip_with(left, right, lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + F.coalesce(x, F.lit(0.0)))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))
