"""Joins of large facts with dimensions of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(facts: DataFrame, dim: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Facts with a dimension (inner, left or left_anti).

    Spark compares the dimension with ``spark.sql.autoBroadcastJoinThreshold``: within it the
    facts stay where they are, beyond it both sides are shuffled, and adaptive execution splits
    the facts of a hot key over several tasks as soon as it has seen the shuffled sizes. Nothing
    runs while the join is being built.
    """
    added = [] if how == "left_anti" else [c for c in dim.columns if c != key]
    return facts.join(dim, key, how).select(*facts.columns, *added)


def one_row_per_key(dim: DataFrame, key: str, value: str, position: str = "position") -> DataFrame:
    """``key, value`` with the last value by position, so that a lookup cannot repeat facts.

    Without a position column the greatest value is taken.
    """
    order = position if position in dim.columns else value
    return dim.groupBy(key).agg(F.max_by(value, order).alias(value))
