"""Tables of vectors, packed as blocks of whole numbers for the operators that pass over them often."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.llm.common import map_rows, materialize

# Entries are turned into floor(64 * entry); beyond this size sums of squares leave 64 bits.
SCALE, LARGEST = 64, 2.0**18
# Vectors of a block.
BLOCK = 1024


def usable(vector: str) -> Column:
    """Vectors without null, non-finite or overlarge (above 2^18) entries; a null is not usable."""
    good = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) <= LARGEST, F.lit(False)))
    return F.coalesce(good, F.lit(False))


def packed(rows: DataFrame, id_column: str, vector: str, size: int, shift: int = 0) -> DataFrame:
    """``ids, x``: blocks of usable vectors of one size with ``floor(64 * entry) + shift`` as 64-bit numbers.

    The table is written once; a block is at most ``BLOCK`` vectors, so a task reads it piece by
    piece, and no rows move between tasks.
    """

    def work(batches):
        for ids, vectors in batches:
            for start in range(0, len(ids), BLOCK):
                part = vectors.slice(start, BLOCK)
                values = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(part), size)
                numbers = np.floor(values * SCALE).astype(np.int64) + shift
                yield [ids.slice(start, BLOCK).to_pylist()], [numbers.tobytes()]

    return materialize(map_rows(rows, [id_column, vector], work, "ids array<long>, x binary"))


def matrix(block: bytes, size: int) -> np.ndarray:
    return np.frombuffer(block, np.int64).reshape(-1, size)
