"""Token ids in shards of wavelet matrices.

A wavelet matrix holds a sequence of ids as one row of bits per binary digit, most significant
first; after each row the sequence is split, stably, into those with a 0 and those with a 1. With
the ranks of the rows kept per block, single ids, counts and places of an id are found from the
compressed rows without decoding the sequence.

A shard is one Parquet file, a range of document ids in ascending order. Its rows are segments of
whole documents, each a matrix with its ids and document borders in the format below, all numbers
little-endian:

    "WVM1", planes u32, tokens u64, documents u64, zeros per plane u64 each,
    document ids i64 each, document starts u64 each and one more for the end,
    per plane: bits, the first one lowest, padded to whole blocks of 512; ones before each block u32
"""

from __future__ import annotations

import os
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywood.llm.common import map_rows, partitions, with_range
from tallywood.llm.word_memory import WordMemory

MAGIC = b"WVM1"
BLOCK = 512
# A segment ends with the document that brings it to so many tokens.
SEGMENT = 1 << 18
# Strings that are handed to the tokenizer as one.
RUN = 256
# Words whose ids a Python worker remembers, some 30 bytes each.
REMEMBERED = 1_000_000
# Bytes of text that are encoded together: a word is looked up once in them.
TOGETHER = 8_000_000


class WaveletMatrix:
    """Access, counts and places of ids on the bit rows of one sequence."""

    def __init__(self, rows: list[np.ndarray], ranks: list[np.ndarray], zeros: list[int], size: int):
        self.rows, self.ranks, self.zeros, self.size = rows, ranks, zeros, size

    @classmethod
    def build(cls, ids: np.ndarray, planes: int) -> WaveletMatrix:
        kind = np.uint16 if planes <= 16 else np.uint32
        values = ids.astype(kind)
        rows, ranks, zeros = [], [], []
        for plane in range(planes - 1, -1, -1):
            bits = (values >> kind(plane) & kind(1)).astype(bool)
            packed = np.packbits(bits, bitorder="little")
            packed = np.pad(packed, (0, -len(packed) % (BLOCK // 8)))
            ones = np.bitwise_count(packed.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1)
            ranks.append((np.cumsum(ones) - ones).astype(np.uint32))
            rows.append(packed)
            left = values[~bits]
            zeros.append(len(left))
            values = np.concatenate([left, values[bits]])
        return cls(rows, ranks, zeros, len(ids))

    def bit(self, level: int, place: int) -> int:
        return int(self.rows[level][place >> 3]) >> (place & 7) & 1

    def rank(self, level: int, place: int) -> int:
        """Ones before a place of a row."""
        if place >= self.size:
            place = self.size
        block = place // BLOCK
        if block >= len(self.ranks[level]):
            return self.size - self.zeros[level]
        start = block * BLOCK // 8
        ones = int(np.bitwise_count(self.rows[level][start:place >> 3]).sum())
        rest = int(self.rows[level][place >> 3]) & (1 << (place & 7)) - 1 if place & 7 else 0
        return int(self.ranks[level][block]) + ones + rest.bit_count()

    def access(self, place: int) -> int:
        """The id at a place."""
        value = 0
        for level in range(len(self.rows)):
            one = self.bit(level, place)
            ones = self.rank(level, place)
            place = self.zeros[level] + ones if one else place - ones
            value = value << 1 | one
        return value

    def _range(self, value: int, start: int, end: int) -> tuple[int, int]:
        for level in range(len(self.rows)):
            a, b = self.rank(level, start), self.rank(level, end)
            if value >> (len(self.rows) - 1 - level) & 1:
                start, end = self.zeros[level] + a, self.zeros[level] + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, value: int, start: int = 0, end: int | None = None) -> int:
        """How often an id occurs from ``start`` to before ``end``."""
        if value < 0 or value >> len(self.rows):
            return 0
        a, b = self._range(value, start, self.size if end is None else end)
        return b - a

    def select(self, level: int, one: int, number: int) -> int:
        """Place of the bit of a kind that has ``number`` of its kind before it."""
        ranks = self.ranks[level].astype(np.int64)
        before = ranks if one else np.arange(len(ranks)) * BLOCK - ranks
        block = int(np.searchsorted(before, number, "right")) - 1
        raw = self.rows[level][block * BLOCK // 8:(block + 1) * BLOCK // 8]
        bits = np.unpackbits(raw, bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits == one)[number - int(before[block])])

    def places(self, value: int) -> list[int]:
        """All places of an id, ascending, from the last row back to the first."""
        if not self.count(value):
            return []
        start, end = self._range(value, 0, self.size)
        found = []
        for place in range(start, end):
            for level in range(len(self.rows) - 1, -1, -1):
                one = value >> (len(self.rows) - 1 - level) & 1
                place = self.select(level, one, place - self.zeros[level] if one else place)
            found.append(place)
        return found

    def ids(self) -> np.ndarray:
        """The whole sequence, by undoing the splits from the last row to the first."""
        planes = len(self.rows)
        values = np.zeros(self.size, np.uint16 if planes <= 16 else np.uint32)
        for level in range(planes - 1, -1, -1):
            bits = np.unpackbits(self.rows[level], count=self.size, bitorder="little").astype(bool)
            merged = np.empty_like(values)
            merged[~bits] = values[:self.zeros[level]]
            merged[bits] = values[self.zeros[level]:] | values.dtype.type(1 << (planes - 1 - level))
            values = merged
        return values


def pack(ids: np.ndarray, doc_ids: list[int], starts: list[int], planes: int) -> bytes:
    """One segment in the format above."""
    matrix = WaveletMatrix.build(ids, planes)
    parts = [MAGIC, struct.pack("<IQQ", planes, len(ids), len(doc_ids)), np.array(matrix.zeros, "<u8").tobytes()]
    parts += [np.array(doc_ids, "<i8").tobytes(), np.array(starts, "<u8").tobytes()]
    for row, ranks in zip(matrix.rows, matrix.ranks, strict=True):
        parts += [row.tobytes(), ranks.astype("<u4").tobytes()]
    return b"".join(parts)


def unpack(blob: bytes) -> tuple[WaveletMatrix, np.ndarray, np.ndarray]:
    """The matrix of a segment, its document ids and their starts."""
    if blob[:4] != MAGIC:
        raise ValueError("not a segment of a wavelet shard")
    planes, size, documents = struct.unpack_from("<IQQ", blob, 4)
    at = 4 + 20

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(blob, kind, n, at)
        at += found.nbytes
        return found

    zeros = take("<u8", planes).tolist()
    doc_ids, starts = take("<i8", documents), take("<u8", documents + 1).astype(np.int64)
    blocks, rows, ranks = -(-size // BLOCK), [], []
    for _ in range(planes):
        rows.append(take("u1", blocks * BLOCK // 8))
        ranks.append(take("<u4", blocks))
    return WaveletMatrix(rows, ranks, zeros, size), doc_ids, starts


def _words_in_runs(encode: Callable[[list[str]], list[bytes]], widths: np.ndarray, kind: type) -> Callable:
    """``encode`` for an Arrow array of words, each with a space in front, which are encoded in runs.

    Where every piece of a byte-level tokenizer begins at such a space, the ids of a run are those
    of its words one behind the other, and ``widths``, the bytes of each token, tell where a word
    ends. A run in which a border falls into a token is encoded word by word.
    """

    def ids(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        starts = [*range(0, len(words), RUN), len(words)]
        runs = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), words), " ")
        found, counts = [np.zeros(0, kind)], np.zeros(len(words), np.int64)
        for start, end, raw in zip(starts, starts[1:], encode([" " + run for run in runs.to_pylist()])):
            own, bytes_ = np.frombuffer(raw, kind), np.cumsum(sizes[start:end])
            ends = np.cumsum(widths[own])
            cut = np.searchsorted(ends, bytes_)
            if len(ends) and ends[-1] == bytes_[-1] and np.array_equal(ends[cut], bytes_):
                counts[start:end] = np.diff(cut, prepend=-1)
                found.append(own)
            else:
                alone = [np.frombuffer(r, kind) for r in encode([" " + w for w in words[start:end].to_pylist()])]
                counts[start:end] = list(map(len, alone))
                found += alone
        return np.concatenate(found), counts

    return ids


def _in_runs(encode: Callable[[list[str]], list[bytes]], widths: np.ndarray, kind: type) -> Callable:
    """``encode`` for many short strings: those with a space in front are encoded in runs."""
    words = _words_in_runs(encode, widths, kind)

    def ids(strings: list[str]) -> list[bytes]:
        found: list[bytes] = [b""] * len(strings)
        spaced = [i for i, s in enumerate(strings) if s[:1] == " "]
        values, counts = words(pa.array([strings[i][1:] for i in spaced], pa.string()))
        for i, own in zip(spaced, np.split(values, np.cumsum(counts)[:-1])):
            found[i] = own.tobytes()
        rest = [i for i, s in enumerate(strings) if s[:1] != " "]
        for i, raw in zip(rest, encode([strings[i] for i in rest]), strict=True):
            found[i] = raw
        return found

    return ids


def _together(batches: Iterator[tuple], size: int = TOGETHER) -> Iterator[tuple]:
    """Batches put together until their texts, the last column, have so many bytes."""
    held, bytes_ = [], 0
    for batch in batches:
        held.append(batch)
        bytes_ += batch[-1].nbytes
        if bytes_ >= size:
            yield tuple(map(pa.concat_arrays, zip(*held, strict=True)))
            held, bytes_ = [], 0
    if held:
        yield tuple(map(pa.concat_arrays, zip(*held, strict=True)))


_OPEN: dict[tuple, tuple] = {}


def _encoder(name: str, shared, split_special: bool) -> tuple[WordMemory, int]:
    """The tokenizer of a Python worker with its memory of words, and the planes of its ids."""
    key = name, split_special
    if key not in _OPEN:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(shared.value)
        tokenizer.encode_special_tokens = split_special
        planes = max(1, (tokenizer.get_vocab_size() - 1).bit_length())
        code = "H" if planes <= 16 else "I"

        def encode(strings: list[str]) -> list[bytes]:
            found = tokenizer.encode_batch_fast(strings, add_special_tokens=False)
            return [array(code, e.ids).tobytes() for e in found]

        vocabulary = tokenizer.get_vocab()
        widths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        widths[list(vocabulary.values())] = list(map(len, vocabulary))
        kind = np.uint16 if planes <= 16 else np.uint32
        words = _words_in_runs(encode, widths, kind)
        _OPEN[key] = WordMemory(_in_runs(encode, widths, kind), kind, REMEMBERED, words, TOGETHER), planes
    return _OPEN[key]


def write_shards(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, id_column: str = "doc_id",
    text: str = "text", split_special: bool = False,
) -> None:
    """Encode all texts, end each with ``end_id`` and write the shards below ``path``.

    A null text counts as empty and has the end id alone. Rows are cut into ranges of their ids,
    rows without an id come first with id 0 in their place; rows of one id are in order of their
    texts. Special tokens written out in a text get their ids, as the library has it by default;
    with ``split_special`` they are encoded as ordinary text. Each range has a task of its own, is
    sorted and encoded as a stream, so that a task holds one segment.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())  # the size of the file
    ranges = partitions(spark)
    rows = with_range(docs.select(id_column, text), id_column, ranges)
    rows = rows.repartitionById(ranges, F.col("__range")).sortWithinPartitions(
        "__range", F.asc_nulls_first(id_column), F.asc_nulls_first(text)
    )

    def work(batches):
        memory, planes = _encoder(tokenizer, shared, split_special)
        kind = np.uint16 if planes <= 16 else np.uint32
        end = np.array([end_id], kind).tobytes()
        current, segment, first, size = None, 0, 0, 0
        doc_ids, starts, parts = [], [0], []

        def closed():
            nonlocal segment, first, size, doc_ids, starts, parts
            ids = np.frombuffer(b"".join(parts), kind)
            blob = pack(ids, doc_ids, starts, planes)
            row = [current], [segment], [first], [len(ids)], [len(doc_ids)], [blob]
            segment, first, size = segment + 1, first + len(ids), 0
            doc_ids, starts, parts = [], [0], []
            return row

        for ranges_, ids, texts in _together(batches):
            for shard, doc_id, tokens in zip(ranges_.to_pylist(), ids.to_pylist(), memory.ids(texts), strict=True):
                if doc_ids and (shard != current or size >= SEGMENT):
                    yield closed()
                if shard != current:
                    current, segment, first = shard, 0, 0
                parts += tokens.tobytes(), end
                size += len(tokens) + 1
                doc_ids.append(doc_id or 0)
                starts.append(size)
        if doc_ids:
            yield closed()

    schema = "shard int, segment long, first_token long, n_tokens long, n_docs long, matrix binary"
    segments = map_rows(rows, ["__range", id_column, text], work, schema)
    segments.write.option("compression", "zstd").partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """One row per segment; an empty folder of shards has none."""
    schema = "segment long, first_token long, n_tokens long, n_docs long, matrix binary, shard int"
    return spark.read.schema(schema).parquet(path)


def documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the shards alone.

    ``start`` counts the ids of all documents before it; each shard starts where the totals of
    the shards before it end, one number per shard.
    """
    segments = read_shards(spark, path)
    totals = segments.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__start"))

    def work(batches: Iterator[tuple]):
        for shards, firsts, blobs in batches:
            for shard, first, blob in zip(shards, firsts.to_pylist(), blobs, strict=True):
                matrix, doc_ids, borders = unpack(blob.as_py())
                raw = matrix.ids().astype("<u4")
                bounds = borders.tolist()
                sums = [zlib.crc32(raw[a:b]) for a, b in zip(bounds, bounds[1:])]
                yield [shard.as_py()] * len(doc_ids), doc_ids, first + borders[:-1], np.diff(borders), sums

    schema = "shard int, doc_id long, first long, n_tokens long, ids_crc32 long"
    rows = map_rows(segments, ["shard", "first_token", "matrix"], work, schema)
    return rows.join(F.broadcast(starts), "shard").select(  # one row per shard
        "doc_id", (F.col("first") + F.col("__start")).alias("start"), "n_tokens", "ids_crc32", "shard"
    )


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """``shard, place`` of an id in the shards, counted from the start of each shard."""

    def work(batches):
        for shards, firsts, blobs in batches:
            for shard, first, blob in zip(shards, firsts.to_pylist(), blobs, strict=True):
                places = unpack(blob.as_py())[0].places(token)
                yield [shard.as_py()] * len(places), [first + p for p in places]

    return map_rows(read_shards(spark, path), ["shard", "first_token", "matrix"], work, "shard int, place long")
