"""Word-vector arithmetic on array columns."""

from pyspark.sql import functions as F

from permitry.functions.text import _col


def _wide(c):
    return _col(c).cast("array<double>")


def dot(a, b):
    products = F.zip_with(_wide(a), _wide(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a):
    return F.sqrt(dot(a, a))


def euclidean(a, b):
    squares = F.zip_with(_wide(a), _wide(b), lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def cosine(a, b):
    """Cosine of two vectors; NULL when either has length zero."""
    lengths = norm(a) * norm(b)
    return F.when(lengths > 0, dot(a, b) / lengths)
