"""Vector maths on ``array<double>`` columns (X8), JVM-side higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tastemesh.functions.strings import ColumnOrName, _col


def dot(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Inner product of two equal-length arrays."""
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x * y),
                       F.lit(0.0), lambda acc, v: acc + v)


def norm(a: ColumnOrName) -> Column:
    """Euclidean norm."""
    return F.sqrt(F.aggregate(_col(a), F.lit(0.0), lambda acc, v: acc + v * v))


def cosine(a: ColumnOrName, b: ColumnOrName,
           norm_a: ColumnOrName | None = None, norm_b: ColumnOrName | None = None) -> Column:
    """Cosine similarity; null (not NaN) when either vector has zero norm.

    A NaN score would sort first in a descending order, ranking empty items
    highest, so zero vectors get no score and drop out of top-k lists.
    Precomputed norms can be passed to avoid recomputing them per pair.
    """
    na = norm(a) if norm_a is None else _col(norm_a)
    nb = norm(b) if norm_b is None else _col(norm_b)
    return dot(a, b) / F.nullif(na * nb, F.lit(0.0))


def to_array(vec: ColumnOrName) -> Column:
    """ML vector → ``array<double>`` (both dense and sparse)."""
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(_col(vec), "float64")
