"""Exact sums, means and the two rounding rules in use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mean_of(total: Column, n: Column) -> Column:
    """``total / n`` as a double, null when there is nothing to average."""
    return F.try_divide(total.cast("double"), n.cast("double"))


def exact(value: Column, scale: int = 2) -> Column:
    """A double as a decimal, so that sums do not depend on the order of the rows."""
    return value.cast(f"decimal(18,{scale})")


def fixed_half_even(value: Column, digits: int = 2) -> Column:
    """Text with a fixed number of digits, rounded half to even on the exact binary value."""
    return F.call_function("format_number", value, F.lit("0." + "0" * digits))


def round_half_even(value: Column, digits: int = 2) -> Column:
    """The same as a number; nan and infinities stay what they are."""
    finite = F.abs(value) < F.lit(float("inf"))  # nan is above all numbers
    return F.when(finite, fixed_half_even(F.when(finite, value), digits).cast("double")).otherwise(value)


def fixed_half_up(value: Column, digits: int = 2) -> Column:
    """Text with a fixed number of digits, ties of the printed value rounded away from zero."""
    return F.when(value.isNotNull(), F.format_string(f"%.{digits}f", value))
