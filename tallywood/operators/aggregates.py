"""Aggregates that the jobs share. All of them combine within a task before they shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.functions.numbers import mean_of

TOTAL, COUNT = "__total", "__n"


def totals(df: DataFrame, *keys: str, value: str = "score") -> DataFrame:
    """Sum and count per key, to be combined further by ``combined``."""
    return df.groupBy(*keys).agg(F.sum(value).alias(TOTAL), F.count(value).alias(COUNT))


def combined(partial: DataFrame, *keys: str) -> DataFrame:
    return partial.groupBy(*keys).agg(F.sum(TOTAL).alias(TOTAL), F.sum(COUNT).alias(COUNT))


def with_mean(partial: DataFrame, mean: str, n: str) -> DataFrame:
    """Sum and count replaced by mean and count, after the other columns."""
    others = [c for c in partial.columns if c not in (TOTAL, COUNT)]
    return partial.select(
        *others, mean_of(F.col(TOTAL), F.col(COUNT)).alias(mean), F.col(COUNT).alias(n)
    )


def mean_and_count(df: DataFrame, *keys: str, value: str, mean: str, n: str) -> DataFrame:
    return with_mean(totals(df, *keys, value=value), mean, n)


def cell_totals(conditions: dict[str, Column], value: str = "score") -> list[Column]:
    """Sum and count of ``value`` for each named condition, side by side in one pass."""
    cells = []
    for name, holds in conditions.items():
        cells.append(F.sum(F.when(holds, F.col(value))).alias(f"{name}{TOTAL}"))
        cells.append(F.count(F.when(holds, F.col(value))).alias(f"{name}{COUNT}"))
    return cells


def combined_cells(names: list[str]) -> list[Column]:
    columns = [f"{name}{part}" for name in names for part in (TOTAL, COUNT)]
    return [F.sum(column).alias(column) for column in columns]


def cell_mean(name: str) -> Column:
    return mean_of(F.col(f"{name}{TOTAL}"), F.col(f"{name}{COUNT}"))


def distinct_total(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct values of a column as one row; null counts as a value."""
    return df.select(column).distinct().agg(F.count("*").alias("total"))


def rows_per(df: DataFrame, column: str, counted: str, n: str = "n") -> DataFrame:
    """Rows per value, leaving out rows whose ``counted`` column is null."""
    return df.groupBy(column).agg(F.count(counted).alias(n))
