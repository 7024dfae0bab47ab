"""Small vector arithmetic on array<double> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def truncate_decimals(value: Column, digits: int = 6) -> Column:
    scale = float(10**digits)
    return F.floor(value * scale) / scale


def round6(value: Column) -> Column:
    """Half-up at six digits; both engines of a comparison can express it."""
    return F.floor(value * 1e6 + 0.5) / 1e6


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def l2_normalise(a: Column) -> Column:
    """Unit length; a zero vector stays zero. ``norm`` goes through a one-element array so
    that it is evaluated once per row and not once per component."""
    return F.flatten(
        F.transform(
            F.array(norm(a)),
            lambda n: F.transform(a, lambda x: F.when(n > 0, x / n).otherwise(x)),
        )
    )
