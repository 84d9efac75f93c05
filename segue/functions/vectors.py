"""Column functions on arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from segue.functions.scalars import _col


def total(values: Column | str) -> Column:
    return F.aggregate(_col(values), F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def dot(a: Column | str, b: Column | str) -> Column:
    return total(F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")))


def norm(v: Column | str) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalize(v: Column | str) -> Column:
    """Unit length; a zero vector stays as it is. The norm is found once, then used for every element."""
    v = _col(v).cast("array<double>")
    return F.aggregate(
        v, F.lit(0.0), lambda acc, x: acc + x * x,
        lambda squares: F.transform(v, lambda x: F.when(squares == 0, x).otherwise(x / F.sqrt(squares))),
    )


def mean(v: Column | str) -> Column:
    v = _col(v)
    return F.when(F.size(v) > 0, total(v) / F.size(v))


def layer_norm(v: Column | str, eps: float = 1e-3) -> Column:
    """(x - mean) / sqrt(population variance + eps) over the vector; mean and variance are found once each."""
    v = _col(v).cast("array<double>")
    n = F.size(v)

    def scaled(added: Column) -> Column:
        def finish(squares: Column) -> Column:
            return F.transform(v, lambda x: (x - added / n) / F.sqrt(squares / n + F.lit(eps)))

        return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + (x - added / n) * (x - added / n), finish)

    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x, scaled)


def zscore(v: Column | str, centre: float, variance: float, array: bool = False) -> Column:
    """(x - mean) / sqrt(variance) with stored constants, for a number or an array of numbers."""
    def one(x: Column) -> Column:
        return (x.cast("double") - F.lit(centre)) / F.sqrt(F.lit(variance))

    return F.transform(_col(v), one) if array else one(_col(v))


def mean_nested(v: Column | str) -> Column:
    """Mean over positions and the grams at each position."""
    return mean(F.flatten(_col(v)))


def has_nan(v: Column | str) -> Column:
    return F.exists(_col(v), lambda x: F.isnan(x))


def concat_features(*parts: Column | str) -> Column:
    """One vector from numbers and arrays, in the order given."""
    return F.concat(*[_col(p) for p in parts])
