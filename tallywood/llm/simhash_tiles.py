"""SimHash near-duplicates by exact comparison of tiles."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.llm.common import map_rows, materialize, partitions, slices
from tallywood.llm.components import components

SEED = 42
# Shingles whose bits are counted in one piece of work.
COUNTED = 65_536
# Fingerprints of a meeting place that are compared with each other in one piece of work.
BLOCK = 512
_ONES = np.uint64(0x1111111111111111)


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of every ``width``-word shingle of a text, repeats included.

    Words are what stands between ASCII blanks, with A to Z in lower case; a shingle is its words
    joined by one space. A text with fewer words has the whole sequence as its only shingle, a
    text without words has none.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    grams = zip(*(words[k:] for k in range(width)), strict=False) if len(words) >= width else [words]
    hashes = map(xxhash.xxh64_intdigest, map(b" ".join, grams), repeat(SEED))
    return np.fromiter(hashes, np.uint64, max(1, len(words) - width + 1))


def majority(sets: list[np.ndarray]) -> np.ndarray:
    """For every array of hashes the bits that over half of them have; zero for an empty one."""
    counts = np.zeros((len(sets), 64), np.int64)
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    hashes = np.concatenate([np.zeros(0, np.uint64), *sets])
    for start in range(0, len(hashes), COUNTED):
        part, own = hashes[start:start + COUNTED], owners[start:start + COUNTED]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        counts[own[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    over = 2 * counts > np.array([len(s) for s in sets], np.int64).reshape(-1, 1)
    return np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, width: int = 3, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, fp`` of every row: the 64 bits as a signed number."""

    def work(batches):
        for ids, texts in batches:
            found = [majority([shingle_hashes(t, width) for t in part]) for part in slices(texts)]
            yield ids, np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)

    return map_rows(docs, [id_column, text], work, f"{id_column} long, fp long")


def tile(fps: np.ndarray) -> np.ndarray:
    """The population counts of the sixteen groups of four bits, as sixteen hexadecimal digits."""
    pairs = fps - ((fps >> np.uint64(1)) & np.uint64(0x5555555555555555))
    return (pairs & np.uint64(0x3333333333333333)) + ((pairs >> np.uint64(2)) & np.uint64(0x3333333333333333))


def meeting_places(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The number of a fingerprint and a tile where it meets others, for all of some fingerprints.

    A bit that differs changes one population count by one. So the tiles of two fingerprints
    within the radius differ by at most the radius in all, and some tile between the two is within
    half of it, rounded up, of both. Tiles that differ by more have no such tile and never meet.
    """
    owners, places = np.arange(len(fps)), tile(fps)
    for _ in range((radius + 1) // 2):
        near_owners, near = [owners], [places]
        for group in range(16):
            one = np.uint64(1 << 4 * group)
            digit = (places >> np.uint64(4 * group)) & np.uint64(15)
            near_owners += [owners[digit < 4], owners[digit > 0]]
            near += [places[digit < 4] + one, places[digit > 0] - one]
        both = np.unique(np.stack([np.concatenate(near_owners).astype(np.uint64), np.concatenate(near)]), axis=1)
        owners, places = both[0].astype(np.int64), both[1]
    return owners, places


def linked(fps: np.ndarray, radius: int, blocks: np.ndarray | None = None) -> np.ndarray:
    """The least place among some fingerprints that links reach, for each of them.

    With ``blocks`` only fingerprints of different blocks are compared.
    """
    n = len(fps)
    close = np.zeros((n, n), bool)
    for start in range(0, n, 64):
        rows = slice(start, start + 64)
        close[rows] = np.bitwise_count(fps[rows, None] ^ fps[None, :]) <= radius
        if blocks is not None:
            close[rows] &= blocks[rows, None] != blocks[None, :]
    np.fill_diagonal(close, True)
    label = np.arange(n)
    while True:
        least = np.where(close, label[None, :], n).min(axis=1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _links(place: np.ndarray, left: np.ndarray, block: np.ndarray, fps: np.ndarray, radius: int) -> Iterator[tuple]:
    """Links ``a, b`` that join what belongs together in every run of one piece of work."""
    edges = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (left[1:] != left[:-1]), [True]]))
    sizes = np.diff(edges)
    # Runs of two, most of them, all at once.
    twos = edges[:-1][sizes == 2]
    near = np.bitwise_count(fps[twos] ^ fps[twos + 1]) <= radius
    yield fps[twos + 1][near], fps[twos][near]
    for start, size in zip(edges[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        own, run = fps[start:start + size], block[start:start + size]
        label = linked(own, radius, run if (run != run[0]).any() else None)
        moved = label != np.arange(size)
        if moved.any():
            yield own[moved], own[label[moved]]


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """``a, b``: links between different fingerprints ``fp`` that reach all that are within the radius.

    Every fingerprint goes to its own tile and to the tiles next to it (32 at most for a radius of
    2). What meets in a tile is compared in full by exclusive-or and bit counts, in blocks, each
    with itself and with every other. Of the links within a piece of work only as many as hold its
    members together are returned, so a cluster of m fingerprints gives no more than m of them.
    """
    spark = distinct.sparkSession

    def spread(batches):
        for (values,) in batches:
            fps = values.to_numpy().view(np.uint64)
            for start in range(0, len(fps), 4096):
                part = fps[start:start + 4096]
                owners, places = meeting_places(part, radius)
                yield places.view(np.int64), part[owners].view(np.int64)

    def compare(batches):
        held = None
        for batch in batches:
            rows = np.stack([c.to_numpy().astype(np.int64) for c in batch])
            held = rows if held is None else np.concatenate([held, rows], axis=1)
            if not held.size:
                continue
            last = _last_run(held)  # the last run may go on in the next batch
            yield from _signed(held[:, :last])
            held = held[:, last:]
        if held is not None and held.size:
            yield from _signed(held)

    def _last_run(rows):
        same = (rows[0] == rows[0, -1]) & (rows[1] == rows[1, -1]) & (rows[2] == rows[2, -1])
        return int(np.flatnonzero(same)[0])

    def _signed(rows):
        if rows.shape[1]:
            work = rows[1] * (1 << 31) + rows[2]
            for a, b in _links(rows[0], work, rows[3], rows[4].view(np.uint64), radius):
                yield a.view(np.int64), b.view(np.int64)

    places = materialize(map_rows(distinct, ["fp"], spread, "place long, fp long"))
    shared = places.groupBy("place").agg(F.count("*").alias("members")).where("members > 1")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    others = F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j")))
    dealt = places.join(shared, "place").select("place", F.inline(others), own.alias("block"), "fp")
    dealt = dealt.select("place", "i", "j", "block", "fp")
    dealt = dealt.repartition(partitions(spark), "place", "i", "j").sortWithinPartitions("place", "i", "j", "fp")
    return map_rows(dealt, ["place", "i", "j", "block", "fp"], compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, radius: int = 2, width: int = 3, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``id, fingerprint, component_id`` of every row; the fingerprint as 16 hexadecimal digits.

    Two rows link if their fingerprints differ in ``radius`` bits or fewer; ``component_id`` is
    the least id that links reach. Null texts and texts without words have the fingerprint zero
    and link like any other. A row without an id stays, reaches what it links with, and has no
    component where nothing in reach has an id. Repeated rows and ids are rows like any other.

    1. Equal fingerprints become one, combined within tasks, so copies cost one row from there on.
    2. Fingerprints with the same population counts of each four bits are a tile; tiles meet only
       where their counts differ by the radius or less in all.
    """
    base = materialize(fingerprints(docs, width, id_column, text))
    distinct = materialize(base.groupBy("fp").agg(F.min(id_column).alias("least_id")))
    found = components(links(distinct, radius))
    named = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    named = materialize(named.withColumn("component", F.coalesce("component", "fp")))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    known = named.join(least, "component").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return base.join(known, "fp").select(id_column, digits, "component_id")
