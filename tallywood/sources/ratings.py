"""Ratings, items, users and code lists from delimited text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.functions.parsing import field, fields_of, split_list, strip, to_double, to_long
from tallywood.sources.lines import POSITION, read_lines, records

# A comma line holds the id before its first comma and the genres after its
# last one, so that a title may hold commas of its own.
ITEM_PATTERN = r"^([^,]*),(.*),([^,]*)$"


def _split(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return read_lines(spark, paths).select(fields_of(F.col("value")).alias("parts"))


def read_ratings(
    spark: SparkSession, paths: str | list[str], timed: bool = True
) -> DataFrame:
    """``user_id, item_id, score, ts``; a line with any unreadable field is dropped.

    Analyses that do not use the time may read with ``timed=False``, which accepts lines
    without a readable time.
    """
    parts = F.col("parts")
    fields = {
        "user_id": to_long(field(parts, 0)),
        "item_id": to_long(field(parts, 1)),
        "score": to_double(field(parts, 2)),
        "ts": to_long(field(parts, 3)),
    }
    required = [name for name in fields if timed or name != "ts"]
    return records(_split(spark, paths), fields, required)


def read_items(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``item_id, title, genres, position``; genres are an array without empty entries."""
    line = F.col("value")
    by_commas = F.array(*[F.regexp_extract(line, ITEM_PATTERN, i) for i in (1, 2, 3)])
    parts = F.when(line.contains("::"), F.split(line, "::", -1)).when(
        line.rlike(ITEM_PATTERN), by_commas
    )
    split = read_lines(spark, paths).select(parts.alias("parts"), POSITION)
    fields = {
        "item_id": to_long(field(F.col("parts"), 0)),
        "title": strip(field(F.col("parts"), 1)),
        "genres": split_list(field(F.col("parts"), 2)),
        POSITION: F.col(POSITION),
    }
    return records(split, fields, ["item_id", "title", "genres"])


def read_users(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``user_id, gender, age, occupation_id, zip``; all five fields are required."""
    parts = F.col("parts")
    fields = {
        "user_id": to_long(field(parts, 0)),
        "gender": strip(field(parts, 1)),
        "age": to_long(field(parts, 2)).cast("int"),
        "occupation_id": strip(field(parts, 3)),
        "zip": strip(field(parts, 4)),
    }
    return records(_split(spark, paths), fields, list(fields))


def read_codes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``code, name, position``, cut at the first ``::``, tab or comma, in that order."""
    line = F.col("value")
    parts = (
        F.when(line.contains("::"), F.split(line, "::", 2))
        .when(line.contains("\t"), F.split(line, "\t", 2))
        .otherwise(F.split(line, ",", 2))
    )
    split = read_lines(spark, paths).select(parts.alias("parts"), POSITION)
    fields = {
        "code": strip(field(F.col("parts"), 0)),
        "name": strip(field(F.col("parts"), 1)),
        POSITION: F.col(POSITION),
    }
    return records(split, fields, ["code", "name"])
