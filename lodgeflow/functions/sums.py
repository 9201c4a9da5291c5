"""Sums of floating-point values that do not depend on the order of the rows.

A value is cut into three whole numbers, units of 1, 2^-26 and 2^-52, whose sums
are exact. So any partitioning of the rows, and any grouping of partial sums,
gives the same bits. Every value within 2^36 of zero counts as its nearest
multiple of 2^-52, which for 32-bit floats above 2^-29 is the value itself.
Other values (huge, infinite, NaN) are summed apart as floating-point numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEP = 2.0**26
_REACH = 2.0**36

#: The columns of a partial sum; all of them add up.
PARTS = ("whole", "middle", "low", "rest", "n")


def exact_parts(value: Column, prefix: str = "_") -> dict[str, Column]:
    """Aggregates by name that hold the partial sum of ``value`` and the number of its non-null values."""
    value = value.cast("double")
    inside = F.abs(value) < _REACH  # NaN is greater than any number
    whole = F.floor(value)
    scaled = (value - whole) * _STEP
    middle = F.floor(scaled)
    low = F.round((scaled - middle) * _STEP)
    parts = {
        "whole": F.sum(F.when(inside, whole.cast("bigint"))),
        "middle": F.sum(F.when(inside, middle.cast("bigint"))),
        "low": F.sum(F.when(inside, low.cast("bigint"))),
        "rest": F.sum(F.when(~inside, value)),
        "n": F.count(value),
    }
    return {f"{prefix}{name}": part for name, part in parts.items()}


def merged_parts(prefix: str = "_") -> dict[str, Column]:
    """Aggregates that add up partial sums."""
    return {f"{prefix}{name}": F.sum(f"{prefix}{name}") for name in PARTS}


def exact_sum(parts: dict[str, Column] | None = None, prefix: str = "_") -> Column:
    """The sum as a double, from the columns of a partial sum, or from aggregates of either kind above.

    Null if there are no values.
    """
    part = (lambda name: parts[f"{prefix}{name}"]) if parts else (lambda name: F.col(f"{prefix}{name}"))
    zero = lambda name: F.coalesce(part(name), F.lit(0))
    total = zero("whole") + (zero("middle") + zero("low") / _STEP) / _STEP
    return F.when(part("n") > 0, total + F.coalesce(part("rest"), F.lit(0.0)))


def exact_mean(value: Column) -> Column:
    """``avg`` of ``value`` that gives the same bits for any order of the rows; null without values."""
    parts = exact_parts(value)
    return F.try_divide(exact_sum(parts), parts["_n"])


def mean_of_parts(prefix: str = "_") -> Column:
    """The mean from aggregated partial sums."""
    parts = merged_parts(prefix)
    return F.try_divide(exact_sum(parts, prefix), parts[f"{prefix}n"])
