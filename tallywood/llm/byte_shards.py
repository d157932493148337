"""Contiguous shards of equal bytes from global prefix sums of sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywood.llm.common import materialize, partitions, with_range


def prefix_sums(sizes: DataFrame, key: str, size: str, *ties: str) -> DataFrame:
    """Rows with ``before`` (sizes of all earlier rows), ``row_number`` from 0 and ``total``.

    Rows are ordered by ``key``, nulls first, then by size and ``ties``. They are cut into ranges
    of the key and written once; each range is summed on its own and starts where the totals of
    the ranges before it end. The totals, one row per range, are all that meets in one place.
    """
    spark = sizes.sparkSession
    rows = materialize(with_range(sizes, key, partitions(spark)))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("__range").agg(F.sum(size).alias("__sum"), F.count("*").alias("__n"))
    starts = totals.select(
        "__range",
        F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__start"),
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__first"),
        F.sum("__sum").over(Window.partitionBy(F.lit(0))).alias("total"),
    )
    within = Window.partitionBy("__range").orderBy(F.asc_nulls_first(key), size, *ties)
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.withColumn("before", F.sum(size).over(so_far) - F.col(size))
    summed = summed.withColumn("row_number", F.row_number().over(within) - 1)
    joined = summed.join(F.broadcast(starts), "__range")  # one row per range
    return joined.select(
        *sizes.columns, (F.col("before") + F.col("__start")).alias("before"),
        (F.col("row_number") + F.col("__first")).alias("row_number"), "total",
    )


def shard_by_bytes(
    docs: DataFrame, shards: int, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``id, size, text_crc32, shard, slot``: shards of consecutive ids with equal shares of bytes.

    The size of a row is that of its text in UTF-8 and one byte more; a null text counts as empty.
    The bytes of all rows in order of their ids are cut at equal targets, and a row belongs to the
    shard in which its middle lies, so that a shard differs from its target by no more than about
    the largest row. ``slot`` counts the rows of a shard from 0 without gaps. Texts themselves are
    not shuffled. Rows of one id stand in order of size and checksum; an empty table has no rows.
    """
    octets = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    checksum = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    sizes = docs.select(id_column, octets.alias("size"), checksum.alias("text_crc32"))
    rows = prefix_sums(sizes, id_column, "size", "text_crc32")
    middle = f"(2 * before + size) * {shards} div (2 * total)"
    placed = rows.withColumn("shard", F.expr(f"cast(least({middle}, {shards - 1}) as int)"))
    first = placed.groupBy("shard").agg(F.min("row_number").alias("__least"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        id_column, "size", "text_crc32", "shard",
        (F.col("row_number") - F.col("__least")).cast("long").alias("slot"),
    )
