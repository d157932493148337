"""Clustering around centroids with a progressive search in Walsh-Hadamard coefficients."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.llm.common import map_rows, materialize
from tallywood.llm.vectors import SCALE, matrix, packed, usable


def transform(x: np.ndarray) -> np.ndarray:
    """Exact integer Walsh-Hadamard transform of rows, coefficients in the order of sign changes.

    The number of columns is a power of two. Squared distances of transformed rows are those of
    the rows themselves times that number.
    """
    size = x.shape[1]
    y, half = x.astype(np.int64), 1
    while half < size:
        pairs = y.reshape(len(y), size // (2 * half), 2, half)
        y = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), size)
        half *= 2
    return y[:, sign_changes(size)]


def sign_changes(size: int) -> np.ndarray:
    """Places of the coefficients in the order of the sign changes of their functions."""
    places = np.arange(size)
    bits = size.bit_length() - 1
    gray = places ^ (places >> 1)
    return np.array([int(format(g, f"0{bits}b")[::-1], 2) if bits else 0 for g in gray])


def levels(size: int) -> list[tuple[int, int]]:
    """Coefficients from coarse to fine: the first, then as many again as there were before."""
    ends = [1]
    while ends[-1] < size:
        ends.append(2 * ends[-1])
    return list(zip([0, *ends[:-1]], ends, strict=True))


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of every row, of equally near ones the first, and the squared distance.

    Coefficient differences are added level by level. What is added is a lower bound of the whole
    distance; with the lengths of the parts not yet seen it gives an upper bound. A centroid whose
    lower bound is above the least upper bound is strictly worse and goes; the others are followed
    through all coefficients, which makes their distances exact.
    """
    size = x.shape[1]
    points, centres = transform(x), transform(centroids)
    n, k = len(points), len(centres)
    distance = np.zeros((n, k), np.int64)
    alive = np.ones((n, k), bool)
    left, right = (points * points).sum(axis=1), (centres * centres).sum(axis=1)
    for start, end in levels(size):
        rows, which = np.nonzero(alive)
        gaps = points[rows, start:end] - centres[which, start:end]
        distance[rows, which] += (gaps * gaps).sum(axis=1)
        left = left - (points[:, start:end] ** 2).sum(axis=1)
        right = right - (centres[:, start:end] ** 2).sum(axis=1)
        if end < size:
            unseen = (np.sqrt(left)[:, None] + np.sqrt(right)[None, :]) ** 2
            above = np.where(alive, distance + unseen * (1 + 1e-9) + 1, np.inf).min(axis=1)
            alive &= distance <= above[:, None]
    far = np.where(alive, distance, np.iinfo(np.int64).max)
    best = far.argmin(axis=1)
    return best, far[np.arange(n), best] // size


def starting_centroids(rows: DataFrame, count: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``1:<id>``; equal ids go by their entries."""
    order = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256)
    chosen = rows.where(F.col("id").isNotNull()).select(order.alias("order"), "vector").orderBy("order", "vector").limit(count)
    found = sorted(chosen.collect())
    return np.array([np.floor(np.array(r["vector"], np.float64) * SCALE) for r in found], np.int64)


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: the floor of the mean of their vectors, or what they were."""
    size = centroids.shape[1]

    def work(batches):
        sums, counts = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for (values,) in batches:
            for block in values:
                x = matrix(block.as_py(), size)
                best, _ = nearest(x, centroids)
                np.add.at(sums, best, x)
                counts += np.bincount(best, minlength=len(centroids))
        used = np.flatnonzero(counts)
        yield used, counts[used], sums[used].tolist()

    parts = map_rows(blocks, ["x"], work, "cluster int, n long, sums array<long>")
    each = parts.select("cluster", "n", F.posexplode("sums").alias("place", "total"))
    sums = each.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    out = centroids.copy()
    for cluster, place, n, total in sums.collect():  # a row for each centroid and dimension
        out[cluster, place] = int(total) // n
    return out


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(
    table: DataFrame, count: int = 16, rounds: int = 3, size: int = 64, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every usable vector.

    Vectors have exactly ``size`` entries, a power of two; null vectors, other sizes and vectors
    with null, non-finite or overlarge entries (above 2^18, where distances would leave 64 bits)
    are left out. Repeated rows count as often as they stand there. A row without an id has no
    hash: it is never a starting centroid but is assigned like any other. With fewer vectors than
    centroids there are as many centroids as vectors with an id; with none there are no rows.

    All arithmetic is on whole numbers, so the result depends neither on the order of tasks nor on
    their number. What moves between tasks is a sum for each centroid.
    """
    rows = table.select(F.col(id_column).alias("id"), F.col(vector).alias("vector")).where((F.size("vector") == size) & usable("vector"))
    blocks = packed(rows, "id", "vector", size)
    centroids = starting_centroids(rows, count)
    spark = table.sparkSession
    if not len(centroids):
        schema = f"{id_column} long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], schema)
    for _ in range(rounds):
        centroids = moved(blocks, centroids)

    def work(batches):
        for all_ids, values in batches:
            for ids, block in zip(all_ids, values, strict=True):
                yield ids.values, *nearest(matrix(block.as_py(), size), centroids)

    assigned = materialize(map_rows(blocks, ["ids", "x"], work, f"{id_column} long, cluster int, distance long"))
    sums = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    # A row for each centroid: null where a sum exceeds 64 bits.
    whole = sum(sums.values())
    facts = [(c, *(v if v < 2**63 else None for v in (total, whole)), digest(centroids[c])) for c, total in sums.items()]
    known = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(known), "cluster").select(id_column, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
