"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallywood.session import materialize

__all__ = ["fold", "map_rows", "materialize", "partitions", "read_table", "slices", "small_batches", "with_range", "without"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(column: str, folds: int) -> Column:
    """Remainder of the crc32 of a number written as text; decides what is held out."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def map_rows(
    df: DataFrame, columns: list[str], work: Callable[..., Iterator[dict[str, list]]], schema: str
) -> DataFrame:
    """``work(rows)`` on the lists of some columns, batch by batch, as a map without a shuffle.

    ``work`` is given an iterator of tuples of Arrow arrays, so that it can keep what it has
    learned from one batch for the next one of its task, and yields columns as Arrow arrays,
    numpy arrays or lists in the order of ``schema``.
    """
    small_batches(df.sparkSession)
    fields = df.sparkSession.createDataFrame([], schema).schema
    names, types = fields.fieldNames(), [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in work(tuple(batch.columns) for batch in batches):
            arrays = [_array(values, kind) for values, kind in zip(out, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
        # The worker goes on to other tasks; what this one has freed goes back to the machine.
        out = arrays = None
        pa.default_memory_pool().release_unused()
        pa.system_memory_pool().release_unused()

    return df.select(*columns).mapInArrow(run, schema)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def slices(texts: pa.Array, size: int = 1_000_000) -> Iterator[list[str | None]]:
    """The texts of an Arrow array in lists of about ``size`` characters."""
    part, held = [], 0
    for start in range(0, len(texts), 128):
        for value in texts.slice(start, 128).to_pylist():
            part.append(value)
            held += len(value or "")
            if held >= size:
                yield part
                part, held = [], 0
    if part:
        yield part


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 16 << 20) -> None:
    """At most so many rows and bytes move to Python at once, also in a session that allows more.

    Rows may be texts or sets of any length, and a task holds a batch several times.
    """
    for setting, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        setting = f"spark.sql.execution.arrow.{setting}"
        known = spark.conf.get(setting).rstrip("bB")
        if not (known.lstrip("-").isdigit() and 0 < int(known) <= most):
            spark.conf.set(setting, str(most))


def partitions(spark: SparkSession) -> int:
    """Tasks of a shuffle, as the deployment has set them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_range(df: DataFrame, key: str, ranges: int, name: str = "__range") -> DataFrame:
    """Rows with the number of a range of a whole-number key, ascending, of about equal counts.

    The cuts are approximate quantiles from one pass over the key alone, one number for each
    range; they decide how even the ranges are and nothing else. Equal keys share a range, a
    null key belongs to the first.
    """
    points = [i / ranges for i in range(1, ranges)] or [0.5]
    cuts = df.agg(F.percentile_approx(key, points, max(10_000, 20 * ranges))).first()[0] or []

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        known = keys.notna()
        numbers = np.searchsorted(np.array(cuts, np.int64), keys.where(known, 0).astype("int64"), "right")
        return pd.Series(np.where(known, numbers, 0).astype("int32"))

    return df.withColumn(name, place(key))


def without(docs: DataFrame, ids: DataFrame, id_column: str) -> DataFrame:
    """Rows whose id is not among ``ids``; a null id is an id like any other.

    The ids are written once. Spark broadcasts them where their size allows, and beyond that
    shuffles both sides.
    """
    dropped = materialize(ids.select(F.col(id_column).alias("__id")).distinct())
    return docs.join(dropped, F.col(id_column).eqNullSafe(F.col("__id")), "left_anti")
