"""Array expressions that evaluate each part once per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` bound to a lambda variable.

    A column that feeds a lambda may be inlined into it by the optimizer and would
    then be computed per element; a bound variable cannot be.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def run_lengths(sorted_values: Column, key: str = "key", count: str = "n") -> Column:
    """Array of ``(key, n)`` structs from a sorted array: its distinct values and their counts."""

    def starts(s: Column) -> Column:
        indexed = F.transform(s, lambda v, i: F.when((i == 0) | (v != F.get(s, i - 1)), i))
        return F.filter(indexed, lambda i: i.isNotNull())

    def runs(s: Column) -> Column:
        return let(
            starts(s),
            lambda b: F.transform(
                b,
                lambda p, j: F.struct(
                    F.get(s, p).alias(key), (F.coalesce(F.get(b, j + 1), F.size(s)) - p).alias(count)
                ),
            ),
        )

    return let(sorted_values, runs)
