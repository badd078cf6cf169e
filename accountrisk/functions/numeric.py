"""Null-safe numeric column helpers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(column: Column | str) -> Column:
    """Column as double; NaN becomes null."""
    value = (F.col(column) if isinstance(column, str) else column).cast("double")
    return F.when(~F.isnan(value), value)


def at_least(column: Column, lower: float) -> Column:
    """``greatest`` that keeps nulls null."""
    return F.when(column.isNotNull(), F.greatest(column, F.lit(lower)))


def clip(column: Column, lower: float, upper: float) -> Column:
    """Limit to [lower, upper]; nulls stay null."""
    return F.when(
        column.isNotNull(), F.least(F.greatest(column, F.lit(lower)), F.lit(upper))
    )


def rounded(column: Column, digits: int) -> Column:
    """Half-even rounding."""
    return F.bround(column, digits)


def edges_reached(value: Column, edges: Sequence[float], inclusive: bool = True) -> Column:
    """How many of a short list of edges lie at or below (strictly below) the value."""
    if not edges:
        return F.when(value.isNotNull(), F.lit(0))
    hits = [((value >= e) if inclusive else (value > e)).cast("int") for e in map(F.lit, edges)]
    return reduce(lambda a, b: a + b, hits)
