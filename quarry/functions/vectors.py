"""Array-as-vector helpers (F14, F15), all higher-order built-ins."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.predicates import col_

__all__ = ["dot", "norm", "cosine", "argmax", "vec_slice"]


def dot(a, b) -> Column:
    prods = F.zip_with(col_(a), col_(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(col_(a), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a, b) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def argmax(a) -> Column:
    """Zero-based position of the first maximum."""
    return (F.array_position(col_(a), F.array_max(col_(a))) - 1).cast("bigint")


def vec_slice(a, start: int, length: int) -> Column:
    """Zero-based slice."""
    return F.slice(col_(a), start + 1, length)
