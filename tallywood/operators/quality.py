"""Checks of a score that arrives as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_int_score(df: DataFrame, column: str = "review_score") -> DataFrame:
    """The score as an integer; text that is not one becomes null."""
    return df.withColumn(column, F.col(column).try_cast("int"))


def valid_rows(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
    return df.where(F.col(column).between(low, high))


def outlier_rows(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).between(low, high))


def missing_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def quality_split(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
    """Total, missing, outlier and valid rows with the mean of the valid ones, in one pass."""
    score = F.col(column)
    valid = score.between(low, high)
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(score.isNull()).alias("missing"),
        F.count_if(score.isNotNull() & ~valid).alias("outliers"),
        F.count_if(valid).alias("valid"),
        F.round(F.avg(F.when(valid, score)), 2).alias("mean_valid"),
    )


def histogram(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(column)
