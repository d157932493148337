"""Exact distinct counts of whole numbers that can be kept in parts and merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, BITMAP = "bucket", "bitmap"


def distinct_parts(df: DataFrame, groups: list[str], key: str) -> DataFrame:
    """``groups, bucket, bitmap``: the keys of each group as bitmaps of 32,768 keys each.

    Bitmaps are built within tasks before they are shuffled, so a frequent key or a large group
    sends one bitmap per task and bucket. Dense keys take a bit each, scattered ones up to 4 KB.
    Null keys count as none, but their group stays, with a count of 0.
    """
    number = F.col(key).cast("bigint")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITMAP)
    return df.groupBy(*groups, F.bitmap_bucket_number(number).alias(BUCKET)).agg(bits)


def merge_parts(parts: DataFrame, groups: list[str] | list[Column]) -> DataFrame:
    """Parts of several batches, or of finer groups, as one part with one bitmap per bucket."""
    return parts.groupBy(*groups, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def distinct_counts(parts: DataFrame, groups: list[str], name: str) -> DataFrame:
    """``groups`` and the number of distinct keys in all parts together."""
    counts = merge_parts(parts, groups).select(*groups, F.bitmap_count(BITMAP).alias("n"))
    return counts.groupBy(*groups).agg(F.sum("n").alias(name))
