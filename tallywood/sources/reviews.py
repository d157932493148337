"""Review table, stop words and stored tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REVIEW_SCHEMA = "id int, review string, category string, aspect string, sentiment string"
TOKEN_SCHEMA = "id int, word string"


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str) -> DataFrame:
    """Declared columns from unquoted text; a value of the wrong type becomes null.

    Short lines are padded with nulls and extra fields are ignored.
    """
    # An empty quote option switches quoting off; "\\u0000" does the same for escapes.
    options = {"sep": sep, "quote": "", "escape": "\u0000", "mode": "PERMISSIVE", "header": False}
    return spark.read.options(**options).schema(schema).csv(path)


def read_reviews(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    return read_delimited(spark, path, REVIEW_SCHEMA, sep)


def read_tokens(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    return read_delimited(spark, path, TOKEN_SCHEMA, sep)


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """One word per line."""
    return spark.read.text(path).select(F.col("value").alias("word")).where(F.col("word") != "")
