"""Line-oriented reading shared by the text sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.functions.parsing import strip

POSITION = "position"


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Non-empty trimmed lines of one or several files or folders, each file on its own.

    ``position`` orders lines by file and by place in the file. It is read from the split a
    line comes from, so a task that runs again gives the same value.
    """
    raw = spark.read.text(paths)
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return raw.select(strip(F.col("value")).alias("value"), position.alias(POSITION)).where(
        F.col("value") != ""
    )


def records(lines: DataFrame, fields: dict[str, Column], required: list[str]) -> DataFrame:
    """Parsed fields as columns, without the lines that lack a required one.

    Each line is parsed into one generated row. The null checks then read the row instead of
    being pushed below it, where every check would parse its field once more.
    """
    record = F.struct(*[value.alias(name) for name, value in fields.items()])
    return lines.select(F.inline(F.array(record))).dropna(subset=required)
