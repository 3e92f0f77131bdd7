"""Expressions over ``array<float|double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MIN_NORM = 1e-12


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(v: Column | str) -> Column:
    return _col(v).cast("array<double>")


def norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(as_double(v), F.lit(0.0), lambda acc, x: acc + x * x))


def scale(v: Column | str, divisor: Column | str) -> Column:
    d = _col(divisor)
    return F.transform(as_double(v), lambda x: x / d)


def truncate_dims(v: Column | str, dims: int | None) -> Column:
    if dims is None:
        return _col(v)
    if dims <= 0:
        raise ValueError("dims must be positive")
    return F.slice(_col(v), 1, dims)
