"""Jaccard join of documents on word n-grams by PartEnum signatures."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.llm.common import map_rows, materialize, partitions, slices, small_batches
from tallywood.llm.components import components

_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x94D049BB133111EB)


def mixed(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit values with their bits spread, for unsigned arrays."""
    x = values + np.uint64(_MIX[salt % 5] * (salt + 1) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Sets of the n-grams of words, as sorted 64-bit hashes (equal hashes count as equal).

    Words are what stands between ASCII blanks, with A to Z in lower case. A text with fewer words
    than an n-gram has the whole sequence as its only one, a text without words has none.
    """

    REMEMBERED = 150_000

    def __init__(self, width: int):
        self.width, self.words = width, {}

    def of(self, text: str | None) -> np.ndarray:
        return self.of_all([text])[0]

    def of_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """The sets of some texts; the n-grams of all of them are hashed together."""
        known, hashes, sizes = self.words, [], []
        if len(known) > self.REMEMBERED:
            known.clear()
        for text in texts:
            words = text.encode().lower().split() if text else []
            found = list(map(known.get, words))
            if None in found:
                for word in words:
                    if word not in known:
                        known[word] = xxhash.xxh3_64_intdigest(word)
                found = list(map(known.__getitem__, words))
            hashes += found
            sizes.append(len(found))
        values = np.array(hashes, np.uint64)
        grams = {width: self._grams(values, width) for width in {min(n, self.width) for n in sizes} if width}
        sets, start = [], 0
        for n in sizes:
            width = min(n, self.width)
            sets.append(np.unique(grams[width][start:start + n - width + 1]) if n else np.zeros(0, np.uint64))
            start += n
        return sets

    @staticmethod
    def _grams(values: np.ndarray, width: int) -> np.ndarray:
        grams = np.zeros(len(values) - width + 1, np.uint64)
        for place in range(width):
            grams = mixed(grams * np.uint64(_MIX[0]) + values[place:place + len(grams)], place)
        return grams


@dataclass(frozen=True)
class Band:
    """Sizes from ``low`` to before ``high`` and how the sets of it and the next one are cut.

    ``distance`` is the largest symmetric difference of two such sets that are similar enough.
    ``parts`` first-level parts leave one with at most ``differ`` differences; of its ``pieces``
    at most so many differ, so that one of the subsets without so many pieces agrees.
    """

    low: int
    high: int
    distance: int
    parts: int
    pieces: int
    differ: int


class PartEnum:
    """Signatures for sets with a Jaccard similarity of at least ``percent`` / 100.

    Sizes are cut into bands such that similar sets lie in the same band or in neighbouring ones.
    A set has the signatures of its own band, where it meets its band and the next one, and those
    of the band below, as one of the larger sets there.
    """

    def __init__(self, percent: int, pieces: int = 2, differ: int = 1):
        self.percent, self.pieces, self.differ = percent, pieces, differ
        self._band = lru_cache(maxsize=None)(self._find)
        self._edges = [1]

    def number(self, size: int) -> int:
        """Number of the band of a size."""
        edges = self._edges
        while edges[-1] <= size:
            edges.append(edges[-1] * 100 // self.percent + 1)
        return int(np.searchsorted(edges, size, "right")) - 1

    def band(self, number: int) -> Band:
        return self._band(number)

    def _find(self, number: int) -> Band:
        while len(self._edges) < number + 2:
            self._edges.append(self._edges[-1] * 100 // self.percent + 1)
        low, high = self._edges[number], self._edges[number + 1]
        larger = (high - 1) * 100 // self.percent
        distance = (100 - self.percent) * (high - 1 + larger) // (100 + self.percent)
        differ = min(self.differ, distance)
        pieces = self.pieces if differ else 1
        return Band(low, high, distance, distance // (differ + 1) + 1, pieces, differ)

    def signatures(self, hashes: np.ndarray) -> np.ndarray:
        """All signatures of a set; none of an empty one."""
        return self.signatures_of([hashes])[1]

    def signatures_of(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The place of a set and one of its signatures, for all of some sets."""
        bands: dict[int, list[int]] = {}
        for place, hashes in enumerate(sets):
            if len(hashes):
                own = self.number(len(hashes))
                for number in [own, own - 1] if own else [own]:
                    bands.setdefault(number, []).append(place)
        owners, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for number, places in bands.items():
            values = self._of([sets[p] for p in places], number)
            owners.append(np.repeat(np.array(places), values.shape[1]))
            found.append(values.ravel())
        return np.concatenate(owners), np.concatenate(found)

    def _of(self, sets: list[np.ndarray], number: int) -> np.ndarray:
        """Signatures of sets in one band, a row for each set."""
        band = self.band(number)
        cells = band.parts * band.pieces
        hashes = np.concatenate(sets)
        cell = ((hashes >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.int64)
        cell += np.repeat(np.arange(len(sets)) * cells, [len(s) for s in sets])
        ends = np.searchsorted(cell, np.arange(len(sets) * cells + 1))  # ascending, as the hashes are
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(hashes, 1), dtype=np.uint64)])
        held = (sums[ends[1:]] - sums[ends[:-1]]).reshape(len(sets), band.parts, band.pieces)
        chosen = list(combinations(range(band.pieces), band.pieces - band.differ)) if band.differ else [(0,)]
        place = np.arange(band.parts, dtype=np.uint64) + np.uint64(number << 32)
        found = []
        for subset, pieces in enumerate(chosen):
            value = np.broadcast_to(place * np.uint64(64) + np.uint64(subset), held.shape[:2])
            for piece in pieces:
                value = mixed(value, 2) ^ held[:, :, piece]
            found.append(mixed(value, 3))
        return np.concatenate(found, axis=1)


def parity(hashes: np.ndarray, distance: int) -> bytes:
    """A bit row in which every element of a set turns one bit over.

    Where the rows of two sets differ in more bits than a distance, so do the sets; the reverse
    need not hold. The row has a power of two of bits, four times the distance or more.
    """
    bits = max(64, 1 << (4 * distance).bit_length())
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(rows: list[bytes], size: int) -> np.ndarray:
    """Parity rows of any length as a matrix of words; longer rows are folded to ``size`` bytes."""
    out = np.zeros((len(rows), size // 8), np.uint64)
    for place, row in enumerate(rows):
        words = np.frombuffer(row, np.uint64)
        out[place] = words if len(row) == size else np.bitwise_xor.reduce(words.reshape(-1, size // 8), axis=0)
    return out


def apart(distances: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Whether a least distance rules out that sets of these sizes are similar enough."""
    return distances * (100 + percent) > (100 - percent) * (left + right)


def similar(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    """The exact test on two sets."""
    both = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * both >= percent * (len(left) + len(right) - both)


# Members of a signature that are compared with each other in one piece of work.
BLOCK = 1024
# Partners that a set is compared with in one place.
PARTNERS = 1000
# Ids that are sent to every task; beyond it texts are found by a shuffled join.
BROADCAST_IDS = 500_000


def sets(docs: DataFrame, width: int, percent: int, id_column: str, text: str) -> DataFrame:
    """``id, n_shingles, set_id, parity`` of every text; ``set_id`` is a 128-bit hash of the set."""

    def work(batches):
        shingles, enumerated = Shingles(width), PartEnum(percent)
        for ids, texts in batches:
            found = [h for part in slices(texts) for h in shingles.of_all(part)]
            rows = [parity(h, enumerated.band(enumerated.number(len(h))).distance) if len(h) else b"" for h in found]
            yield ids, list(map(len, found)), [xxhash.xxh3_128_digest(h.tobytes()) for h in found], rows

    return map_rows(docs, [id_column, text], work, f"{id_column} long, n_shingles long, set_id binary, parity binary")


def shared_signatures(docs: DataFrame, width: int, percent: int, id_column: str, text: str) -> DataFrame:
    """``sig, id``: the signatures that several rows have, with the ids that have them.

    Equal sets within a task are sent once. The rows of a signature stand next to each other in a
    sorted partition, so they pass by as a stream, however many they are.
    """
    spark = docs.sparkSession

    def emit(batches):
        shingles, enumerated, seen = Shingles(width), PartEnum(percent), set()
        for ids, texts in batches:
            at = 0
            for part in slices(texts):
                fresh = []
                for doc_id, hashes in zip(ids[at:at + len(part)].to_pylist(), shingles.of_all(part), strict=True):
                    key = xxhash.xxh3_128_digest(hashes.tobytes())
                    if key not in seen and doc_id is not None:
                        seen.add(key)
                        fresh.append((doc_id, hashes))
                owner, found = enumerated.signatures_of([h for _, h in fresh])
                if len(found):
                    yield found.view(np.int64), np.array([i for i, _ in fresh], np.int64)[owner]
                at += len(part)

    def repeated(batches):
        last = None  # the latest row, kept back until the next one is known
        for sigs, ids in batches:
            sig, own = sigs.to_numpy(), ids.to_numpy()
            if last is not None:
                sig, own = np.concatenate([last[0], sig]), np.concatenate([last[1], own])
            like_next = sig[:-1] == sig[1:]
            like_last = np.concatenate([[last is not None and last[2]], like_next])
            keep = like_last.copy()
            keep[:-1] |= like_next
            yield sig[:-1][keep[:-1]], own[:-1][keep[:-1]]
            last = sig[-1:], own[-1:], bool(like_last[-1])
        if last is not None and last[2]:
            yield last[0], last[1]

    rows = map_rows(docs, [id_column, text], emit, "sig long, id long")
    rows = rows.repartition(partitions(spark), "sig").sortWithinPartitions("sig")
    return map_rows(rows, ["sig", "id"], repeated, "sig long, id long")


def verified(
    pairs: DataFrame, docs: DataFrame, width: int, percent: int, id_column: str, text: str
) -> DataFrame:
    """The ``a, b`` pairs whose sets are similar enough, by the sets themselves.

    The set of ``b`` travels once, to the place where that of ``a`` waits for it; an ``a`` with
    many partners waits in several places. A task holds the sets of one ``a`` and reads the others
    as a stream.
    """
    spark = docs.sparkSession
    pairs = pairs.distinct()
    places = F.ceil(F.col("partners") / PARTNERS)
    dealt = pairs.join(pairs.groupBy("a").agg(F.count("*").alias("partners")), "a")
    dealt = dealt.select("a", F.pmod(F.xxhash64("b"), places).cast("int").alias("place"), "b")
    waiting = dealt.select("a", "place", F.col("a").alias("b")).distinct()
    sent = materialize(waiting.withColumn("role", F.lit(0)).unionByName(dealt.withColumn("role", F.lit(1))))
    few = sent.count() <= BROADCAST_IDS
    chosen = docs.select(F.col(id_column).alias("b"), F.col(text).alias("text")).join(F.broadcast(sent) if few else sent, "b")

    def shingle(batches):
        shingles, last, hashes = Shingles(width), None, None
        for all_a, all_places, roles, all_b, texts in batches:
            for start in range(0, len(texts), 64):
                found = []
                for own in texts.slice(start, 64):  # one with several places stands several times, one after the other
                    value = own.as_py()
                    if hashes is None or value != last:
                        last, hashes = value, shingles.of(value).tobytes()
                    found.append(hashes)
                yield *(c.slice(start, 64) for c in (all_a, all_places, roles, all_b)), found

    def check(batches):
        key, held = None, []
        for all_a, all_places, roles, all_b, all_hashes in batches:
            kept = []
            rows = zip(all_a.to_pylist(), all_places.to_pylist(), roles.to_pylist(), all_b.to_pylist(), all_hashes, strict=True)
            for a, place, role, b, hashes in rows:
                if (a, place) != key:
                    key, held = (a, place), []
                own = np.frombuffer(hashes.as_py(), np.uint64)
                if role == 0:
                    held.append(own)
                elif any(similar(other, own, percent) for other in held):
                    kept.append((a, b))
            yield [a for a, _ in kept], [b for _, b in kept]

    schema = "a long, place int, role int, b long, hashes binary"
    columns = ["a", "place", "role", "b", "hashes"]
    rows = map_rows(chosen, ["a", "place", "role", "b", "text"], shingle, schema)
    rows = rows.repartition(partitions(spark), "a", "place").sortWithinPartitions("a", "place", "role")
    return map_rows(rows, columns, check, "a long, b long")


def similarity_components(
    docs: DataFrame, width: int = 5, percent: int = 80, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``id, n_shingles, component_id`` of every row.

    Two texts link if the Jaccard similarity of their sets of ``width``-word shingles is at least
    ``percent`` / 100; ``component_id`` is the least id that links reach. Null texts and texts
    without words have empty sets, link with nothing and stand alone; a row without an id has no
    component. Rows that share an id are one document with several texts.

    1. Equal sets become one, that of the least id. Its signatures are grouped; only those with
       several sets go on, and of groups with the same members one.
    2. In each group the set with the most such signatures is its pivot. Each set is compared once,
       with the pivot it shares most signatures with: a rough test on parity rows, which no similar
       pair fails, then the exact one. This links copies of one text in as many comparisons as
       there are copies.
    3. Groups that still hold several components are compared in blocks, across components only.
       Parity rows rule most pairs out and the others are compared exactly, so no link between
       components is lost and no pairs within one are made.
    """
    small_batches(docs.sparkSession)
    base = materialize(sets(docs, width, percent, id_column, text))
    full = base.where(F.col("n_shingles") > 0)
    reps = full.groupBy("set_id").agg(F.min(id_column).alias("rep"), F.first("n_shingles").alias("n"), F.first("parity").alias("parity"))
    reps = materialize(reps.where(F.col("rep").isNotNull()))

    # Signatures are sent under the first id of a task with the set; here all take that of their set.
    named = full.select(F.col(id_column).alias("id"), "set_id").join(reps.select("set_id", "rep"), "set_id").select("id", "rep")
    found = shared_signatures(docs, width, percent, id_column, text)
    groups = materialize(found.join(named, "id").select("sig", "rep").distinct())
    kinds = groups.groupBy("sig").agg(
        F.count("*").alias("members"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "rep")).alias("y")
    )
    # Copies share many signatures; of groups with the same members one is enough, with its weight.
    kept = kinds.where("members > 1").groupBy("members", "x", "y").agg(F.min("sig").alias("sig"), F.count("*").alias("weight"))
    rows = materialize(groups.join(kept.select("sig", "members", "weight"), "sig"))

    degree = rows.groupBy("rep").agg(F.sum("weight").alias("degree"))
    pivots = rows.join(degree, "rep").groupBy("sig").agg(F.max_by("rep", F.struct("degree", "rep")).alias("pivot"))
    choices = rows.join(pivots, "sig").where("rep <> pivot").groupBy("rep", "pivot").agg(F.sum("weight").alias("shared"))
    near = choices.groupBy("rep").agg(F.max_by("pivot", F.struct("shared", "pivot")).alias("a")).withColumnRenamed("rep", "b")
    near = near.join(reps.select(F.col("rep").alias("a"), F.col("n").alias("m"), F.col("parity").alias("other")), "a")
    near = near.join(reps.select(F.col("rep").alias("b"), "n", "parity"), "b")

    def close(batches):
        for a, b, m, n, other, own in batches:
            m, n = m.to_numpy(), n.to_numpy()
            distance = np.array([
                int(np.bitwise_count(np.bitwise_xor(*folded([x, y], min(len(x), len(y))))).sum())
                for x, y in zip(other.to_pylist(), own.to_pylist(), strict=True)
            ], np.int64)
            keep = ~apart(distance, m, n, percent)
            keep &= (100 * m >= percent * n) & (100 * n >= percent * m)
            yield a.to_numpy()[keep], b.to_numpy()[keep]

    near = map_rows(near, ["a", "b", "m", "n", "other", "parity"], close, "a long, b long")
    links = materialize(verified(near, docs, width, percent, id_column, text))
    rest = _between(rows, reps, components(links), percent)
    known = components(links.unionByName(verified(rest, docs, width, percent, id_column, text)))

    out = base.join(reps.select("set_id", "rep"), "set_id", "left")
    out = out.join(known.withColumnRenamed("node", "rep"), "rep", "left")
    return out.select(
        id_column, "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col(id_column)).otherwise(F.coalesce("component", "rep", F.col(id_column))).alias("component_id"),
    )


def _between(rows: DataFrame, reps: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """``a, b``: pairs across components in the groups that hold several, as step 3 needs them."""
    label = F.coalesce("component", "rep").alias("component")
    marked = rows.join(known.withColumnRenamed("node", "rep"), "rep", "left").select("sig", "members", "rep", label)
    marked = materialize(marked)
    open_groups = marked.groupBy("sig").agg((F.min("component") != F.max("component")).alias("open")).where("open")
    # A group of more than one block meets itself block by block.
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    others = F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j")))
    still = marked.join(open_groups.select("sig"), "sig").join(reps.select("rep", "n", "parity"), "rep")
    dealt = still.select("sig", "rep", "n", "parity", "component", own.alias("block"), F.inline(others))

    def across(batches):
        """Pairs of the rows of one (sig, i, j); rows arrive sorted by these."""
        key, held = None, []
        for sig, i, j, *columns in batches:
            keys = list(zip(sig.to_pylist(), i.to_pylist(), j.to_pylist(), strict=True))
            for own_key, row in zip(keys, zip(*(c.to_pylist() for c in columns), strict=True), strict=True):
                if own_key != key:
                    yield from _across(held, percent)
                    key, held = own_key, []
                held.append(row)
        yield from _across(held, percent)

    dealt = dealt.repartition(partitions(rows.sparkSession), "sig", "i", "j").sortWithinPartitions("sig", "i", "j")
    return map_rows(dealt, ["sig", "i", "j", "block", "rep", "n", "component", "parity"], across, "a long, b long")


def _across(rows: list[tuple], percent: int):
    """Pairs of different components among rows that the parity rows do not rule out."""
    if len(rows) < 2:
        return
    block, rep, n, component = (np.array([r[k] for r in rows], np.int64) for k in range(4))
    if (component == component[0]).all():
        return
    size = min(len(r[4]) for r in rows)
    marks = folded([r[4] for r in rows], size)
    # Two blocks: pairs between them; one block with itself: each pair once.
    for k in range(len(rows) - 1):
        other = slice(k + 1, None)
        distance = np.bitwise_count(marks[k] ^ marks[other]).sum(axis=1, dtype=np.int64)
        keep = (component[other] != component[k]) & ~apart(distance, n[other], n[k], percent)
        keep &= (100 * n[other] >= percent * n[k]) & (100 * n[k] >= percent * n[other])
        if block[0] != block[-1] or (block != block[0]).any():
            keep &= block[other] != block[k]
        if keep.any():
            b = rep[other][keep]
            yield np.full(len(b), rep[k]), b
