"""Whitening of embeddings: principal components by Jacobi-Davidson on distributed products."""

from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.llm.common import map_rows
from tallywood.llm.jacobi_davidson import largest_eigenpairs
from tallywood.llm.vectors import matrix, packed, usable

SHIFT = 1_000_000
# Components whose eigenvalue is no more than this share of the largest are rounding errors.
NOTHING = 1e-13


@dataclass(frozen=True)
class Fitted:
    """What whitening needs: count and sums of the vectors, components as columns, eigenvalues."""

    n: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    components: np.ndarray
    identity_error: float


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - S / n`` with one rounding: the numerator ``n * x - S`` is exact."""
    return (n * x - sums) / n


def _sizes(rows: DataFrame, vector: str) -> int:
    """The most common number of entries, of equally common ones the largest; 0 without rows."""
    counts = rows.groupBy(F.size(vector).alias("size")).agg(F.count("*").alias("n"))
    found = counts.orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    return found[0]["size"] if found else 0


def _sums(blocks: DataFrame, size: int) -> tuple[int, list[int], int]:
    """Count, exact sum of each dimension, and the number of tasks that read the table."""

    def work(batches):
        for (values,) in batches:
            for block in values:
                x = matrix(block.as_py(), size)
                yield [TaskContext.get().partitionId()], [len(x)], [x.sum(axis=0).tolist()]

    parts = map_rows(blocks, ["x"], work, "part int, n long, sums array<long>")
    each = parts.select("part", "n", F.posexplode("sums").alias("place", "total"))
    totals = each.groupBy("place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.max("part").alias("last"))
    rows = sorted(totals.collect())
    return (rows[0]["n"], [int(r["total"]) for r in rows], 1 + max(r["last"] for r in rows)) if rows else (0, [], 0)


def covariance_product(blocks: DataFrame, n: int, sums: list[int], tasks: int, vectors: np.ndarray) -> tuple[np.ndarray, float]:
    """The covariance times a block of vectors, and its trace, in one pass over the table.

    Every task returns one small matrix. They are added in the order of the tasks, first in about
    as many groups as each group has members, then on the driver; so the driver gets the square
    root of their number, and a repeated pass has the same result to the last bit.
    """
    size, mean_of = len(sums), np.array(sums, np.int64)

    def work(batches):
        total, squares, part = np.zeros(vectors.shape), 0.0, TaskContext.get().partitionId()
        for (values,) in batches:
            for block in values:
                y = centred(matrix(block.as_py(), size), n, mean_of)
                total += y.T @ (y @ vectors)
                squares += float((y * y).sum())
        yield [part], [total.tobytes()], [squares]

    def add(batches):
        rows = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch), strict=True))
        if rows:
            yield [rows[0][0]], [sum(np.frombuffer(r[1]) for r in rows).tobytes()], [sum(r[2] for r in rows)]

    schema = "part int, total binary, squares double"
    parts = map_rows(blocks, ["x"], work, schema)
    groups = map_rows(parts.repartition(isqrt(tasks) + 1, "part"), ["part", "total", "squares"], add, schema)
    rows = sorted(groups.collect())
    total = sum(np.frombuffer(r["total"]) for r in rows).reshape(vectors.shape)
    return total / n, sum(r["squares"] for r in rows) / n


def fit(blocks: DataFrame, size: int, count: int) -> Fitted | None:
    """Components of packed vectors; None without any.

    The matrix is never built: Jacobi-Davidson asks for its products with blocks of vectors, and
    each is a pass over the table. ``identity_error`` is the largest entry by which the covariance
    of the whitened vectors differs from the identity, from one more product.
    """
    n, sums, tasks = _sums(blocks, size)
    if not n:
        return None
    trace = [0.0]

    def product(vectors: np.ndarray) -> np.ndarray:
        result, trace[0] = covariance_product(blocks, n, sums, tasks, vectors)
        return result

    values, components = largest_eigenpairs(product, size, count)
    there = values > NOTHING * max(values[0], 0)
    values, components = values[there], components[:, there]
    error = 0.0
    if len(values):
        scaled = components / np.sqrt(values)
        error = float(np.abs(scaled.T @ product(scaled) - np.eye(len(values))).max())
    return Fitted(n, tuple(sums), trace[0], values, components, error)


def whiten(
    table: DataFrame, count: int = 32, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error`` per vector and component.

    Entries become ``x = floor(64 * entry) + 1000000``; the components are unit eigenvectors of the
    covariance of all usable vectors, numbered from 1 by falling eigenvalue. ``deviation`` is the
    exact sum of ``(n * x - S)`` squared, null where it exceeds 64 bits.

    Null vectors and those with null, non-finite or overlarge entries (above 2^18) are left out, as
    are vectors whose number of entries is not the most common one (of equally common ones the
    largest). Components without variance are left out too: vectors that are all equal give no
    rows. Rows without an id and repeated rows are rows like any other.
    """
    rows = table.select(F.col(id_column).alias("id"), F.col(vector).alias("vector")).where(usable("vector"))
    size = _sizes(rows, "vector")
    blocks = packed(rows.where(F.size("vector") == size), "id", "vector", size, SHIFT)
    fitted = fit(blocks, size, count) if size else None
    schema = f"{id_column} long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fitted is None or not len(fitted.values):
        return table.sparkSession.createDataFrame([], schema)
    n, sums = fitted.n, np.array(fitted.sums, np.int64)
    scaled, parts = fitted.components / np.sqrt(fitted.values), fitted.values / fitted.trace
    error, k = fitted.identity_error, len(fitted.values)

    def work(batches):
        for all_ids, values in batches:
            for ids, block in zip(all_ids, values, strict=True):
                x = matrix(block.as_py(), size)
                far = n * x - sums
                about = (far.astype(float) ** 2).sum(axis=1)
                exact = (far * far).sum(axis=1)  # right modulo 2^64, whatever overflows on the way
                deviation = np.where(about < 2.0**63 * (1 - 1e-9), exact, -1).repeat(k)
                rows = len(x)
                yield (
                    ids.values.take(np.arange(rows).repeat(k)), np.tile(np.arange(1, k + 1), rows), np.full(rows * k, n),
                    [None if v < 0 else v for v in deviation.tolist()], (far / n @ scaled).ravel(),
                    np.tile(parts, rows), np.full(rows * k, error),
                )

    return map_rows(blocks, ["ids", "x"], work, schema)
