"""Fingerprints of documents: quartile bucket digests of hashed byte triplets.

The triplets of a window that slides over the bytes of a text are hashed to 128 buckets. A digest
holds, in hexadecimal digits, a logarithmic length, the quartiles of the bucket counts relative to
the third one, and for every bucket the quartile that its count falls in. Two digests differ by a
bounded score; equal texts have equal digests.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.llm.common import map_rows, partitions, with_range

BUCKETS = 128
# Offsets of the triplets in a window of four bytes.
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3))
# Differences from here on count as nothing in common.
FARTHEST = 300
# A bucket that falls from the highest to the lowest quartile counts double.
BUCKET_DIFFERENCE = np.array([0, 1, 2, 6])


def counts(texts: list[bytes]) -> np.ndarray:
    """Triplets per bucket, one row per text; texts of fewer than three bytes have none."""
    found = np.zeros((len(texts), BUCKETS), np.int64)
    data = np.frombuffer(b"".join(t + b"\0\0\0" for t in texts), np.uint8).astype(np.uint32)
    size = len(data) - 3
    ends = np.cumsum([len(t) + 3 for t in texts])
    for salt, (a, b, c) in enumerate(TRIPLETS):
        hashed = data[a:size + a] | data[b:size + b] << 8 | data[c:size + c] << 16 | np.uint32(salt << 24)
        hashed = (hashed * np.uint32(0x9E3779B1) >> np.uint32(25)).astype(np.uint8)
        for row, (text, end) in enumerate(zip(texts, ends.tolist(), strict=True)):
            start = end - len(text) - 3
            stop = start + len(text) - c
            if stop > start:
                found[row] += np.bincount(hashed[start:stop], minlength=BUCKETS)
    return found


def digests(texts: list[bytes]) -> list[str]:
    """The digests of texts, 68 hexadecimal digits each; that of an empty text is all zeros."""
    if not texts:
        return []
    found = counts(texts)
    ranked = np.sort(found, axis=1)
    q1, q2, q3 = (ranked[:, BUCKETS * k // 4 - 1] for k in (1, 2, 3))
    codes = (found > q1[:, None]).astype(np.uint8) + (found > q2[:, None]) + (found > q3[:, None])
    codes = codes.reshape(len(texts), -1, 4)
    body = codes[..., 0] | codes[..., 1] << 2 | codes[..., 2] << 4 | codes[..., 3] << 6
    safe = np.maximum(q3, 1)
    length = np.array([round(8 * math.log2(1 + len(t))) for t in texts])
    head = np.stack([np.minimum(length, 255), 15 * q1 // safe | (15 * q2 // safe) << 4], axis=1)
    return [bytes(row).hex() for row in np.concatenate([head, body], axis=1).astype(np.uint8)]


def _codes(prints: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex("".join(prints)), np.uint8).reshape(len(prints), -1).astype(np.int64)
    body = np.stack([raw[:, 2:] >> shift & 3 for shift in (0, 2, 4, 6)], axis=2)
    head = np.stack([raw[:, 0], raw[:, 1] & 15, raw[:, 1] >> 4], axis=1)
    return head, body.reshape(len(prints), -1)


def differences(left: list[str], right: list[str]) -> np.ndarray:
    """Difference score of each pair of digests, 0 to ``FARTHEST``."""
    if not left:
        return np.zeros(0, np.int64)
    (head, body), (other_head, other_body) = _codes(left), _codes(right)
    apart = np.abs(head - other_head)
    # A quarter of a doubling in length is free, then each eighth counts two.
    score = 2 * np.maximum(apart[:, 0] - 2, 0) + 2 * np.maximum(apart[:, 1:] - 1, 0).sum(axis=1)
    return np.minimum(score + BUCKET_DIFFERENCE[np.abs(body - other_body)].sum(axis=1), FARTHEST)


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """1 for equal digests, 0 for those that are ``FARTHEST`` apart."""
    return 1.0 - differences(left, right) / FARTHEST


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_bytes, fingerprint`` of every text; a null text counts as empty. One map."""

    def work(batches):
        for ids, texts in batches:
            raw = [(t or "").encode() for t in texts.to_pylist()]
            yield ids, [len(r) for r in raw], digests(raw)

    return map_rows(docs, [id_column, text], work, f"{id_column} long, n_bytes long, fingerprint string")


def with_next(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``range, id, text, ahead`` in partitions sorted by descending id, so that a row's next one
    follows it.

    Ids are cut into ranges of about equal counts. The first row of a range is repeated behind
    the last one of the range before (``ahead`` is true), that of the first range behind the very
    last row; these are the only texts that move twice. Rows of one id are in order of their
    texts, nulls come last.
    """
    spark = docs.sparkSession
    ranges = partitions(spark)
    rows = with_range(docs.select(id_column, text), id_column, ranges)
    first = rows.groupBy("__range").agg(F.max(id_column).alias("top")).collect()  # one row per range
    firsts = sorted(((r["__range"], r["top"]) for r in first), reverse=True)
    behind = {top: firsts[i - 1][0] for i, (_, top) in enumerate(firsts)}
    known = [top for top in behind if top is not None]
    heads = rows.where(F.col(id_column).isin(known) if None not in behind else
                       F.col(id_column).isin(known) | F.col(id_column).isNull())
    heads = heads.groupBy(id_column).agg(F.max(text).alias(text))
    target = F.lit(behind.get(None, 0))
    if known:
        target = F.coalesce(F.create_map(*[F.lit(x) for top in known for x in (top, behind[top])])[F.col(id_column)], target)
    heads = heads.select(id_column, text, target.cast("int").alias("__range"), F.lit(True).alias("ahead"))
    rows = rows.withColumn("ahead", F.lit(False)).unionByName(heads)
    return rows.repartition(ranges, "__range").sortWithinPartitions(
        F.desc("__range"), "ahead", F.desc_nulls_last(id_column), F.desc_nulls_last(text)
    )


def edited_digests(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """How far digests move when the last third of a text is replaced.

    The edited text of a document has its last ``floor(n_chars / 3)`` code points replaced by the
    first as many (or all) of the next document by descending id; after the last comes the first.
    Returned per row: ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. A null text counts as empty, a lone row is its own next one.
    """

    def finished(rows):
        n = len(rows)
        texts = [row[1] for row in rows]
        edited = []
        for _, own, following in rows:
            cut = len(own) // 3
            edited.append((own[:len(own) - cut] + following[:cut]).encode())
        own = digests([t.encode() for t in texts])
        changed = digests(edited)
        following = digests([rows[-1][2].encode()])
        # The next row's text is in hand but for the last row of a batch.
        after = [*own[1:], *following]
        for k in range(n - 1):
            if rows[k][2] is not texts[k + 1]:
                after[k] = digests([rows[k][2].encode()])[0]
        return (
            [row[0] for row in rows], list(map(len, texts)), [hashlib.sha256(e).hexdigest() for e in edited],
            own, changed, likeness(own, changed), likeness(own, after),
        )

    def work(batches):
        ready, size, waiting = [], 0, None
        for ranges, ids, texts, ahead in batches:
            for at, own, value, extra in zip(ranges.to_pylist(), ids.to_pylist(), texts.to_pylist(), ahead.to_pylist(), strict=True):
                value = value or ""
                if waiting is not None:
                    ready.append((*waiting, value))
                    size += len(value)
                waiting = None if extra else (own, value)
                if size > 4_000_000 or len(ready) >= 4_000:
                    yield finished(ready)
                    ready, size = [], 0
        if ready:
            yield finished(ready)

    schema = (
        f"{id_column} long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return map_rows(with_next(docs, id_column, text), ["__range", id_column, text, "ahead"], work, schema)
