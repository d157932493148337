"""Cross-entropy difference of documents under a target and a background model.

Both are bigram models of words with the same smoothing over one vocabulary, the words of both
corpora and the end of a text:

    P(w | h) = (n(h, w) + mu P(w)) / (n(h) + mu),   P(w) = (n(w) + 1/2) / (N + V/2)

The counts of n-grams grow with the corpus, so no task sees all of them. Documents are dealt into
blocks by the hash of their id. A block sends every n-gram once, with its counts in either corpus,
to the part of the n-grams that its hash names; the part adds the counts of all blocks up and
answers each block in the order of its request. N-grams are hashes (equal ones count as equal) of
so many bits that one in 2**24 n-grams meets another at most; a request is a byte string, a few
bytes per n-gram. Texts are sent to their blocks compressed.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.llm.common import map_rows, materialize
from tallywood.llm.partenum import mixed

# Weight of the unigrams in the bigram model, in words.
MU = 4.0
BLOCK_BYTES = 6 << 20
# A task sends what it has for the blocks when it holds so many bytes.
HELD_BYTES = 16 << 20
# Labels that are sent to every task; beyond it they meet the documents in a shuffled join.
BROADCAST_LABELS = 2_000_000

END, START = np.uint64(1), np.uint64(2)


class Words:
    """Hashes of the words of texts, lower case between blanks; remembers those it has seen."""

    REMEMBERED = 400_000

    def __init__(self):
        self.known: dict[str, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        words = text.lower().split() if text else []
        if len(self.known) > self.REMEMBERED:
            self.known.clear()
        known = self.known
        hashes = list(map(known.get, words))
        if None in hashes:
            for word in words:
                if word not in known:
                    known[word] = xxhash.xxh3_64_intdigest(word.encode())
            hashes = list(map(known.__getitem__, words))
        return np.array(hashes, np.uint64)


class Block:
    """The n-grams of some texts: ``keys`` ascending and the place of each one in it.

    ``history``, ``word`` and ``pair`` are, of each predicted word, the places of the word before,
    of the word itself and of both; ``owner`` is its text. The end of a text is a word, its start
    a history. Texts without words have none of these.
    """

    def __init__(self, texts: list[str | None], target: np.ndarray, words: Words, bits: int = 64):
        parts = [words.of(t) for t in texts]
        self.sizes = np.array([len(p) + 1 if len(p) else 0 for p in parts], np.int64)
        filled = [p for p in parts if len(p)]
        after = [np.append(p, END) for p in filled]
        before = [np.concatenate([[START], p]) for p in filled]
        word = np.concatenate(after) if filled else np.zeros(0, np.uint64)
        history = np.concatenate(before) if filled else np.zeros(0, np.uint64)
        kept, flag = np.uint64(2**64 - 2 ** (65 - bits)), np.uint64(2 ** (64 - bits))
        pair = mixed(mixed(history, 1) + word, 2) & kept
        single = mixed(word, 3) & kept | flag  # the last bit marks words
        start = mixed(START[None], 3) & kept
        self.owner = np.repeat(np.arange(len(texts)), self.sizes)
        self.target = target
        self.keys, place = np.unique(np.concatenate([single, start, pair]), return_inverse=True)
        n = len(word)
        self.word, self.pair, self.start = place[:n], place[n + 1:], place[n:n + 1]
        # A word is the history of the one behind it.
        self.history = np.concatenate([self.start, self.word[:-1]]) if n else self.word
        first = np.cumsum(self.sizes)[self.sizes > 0] - self.sizes[self.sizes > 0]
        self.history[first] = self.start

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """How often each n-gram occurs in target and in background texts."""
        mine = self.target[self.owner]
        starts = np.array([(self.sizes[self.target] > 0).sum(), (self.sizes[~self.target] > 0).sum()])
        found = []
        for chosen, n in ((mine, starts[0]), (~mine, starts[1])):
            total = np.bincount(self.word[chosen], minlength=len(self.keys))
            total += np.bincount(self.pair[chosen], minlength=len(self.keys))
            total[self.start] += n
            found.append(total)
        return found[0], found[1]

    def own(self, places: np.ndarray) -> np.ndarray:
        """Of each predicted word how often its text has the n-gram at that place."""
        code = self.owner * len(self.keys) + places
        _, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
        return counts[inverse]


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part of each key, ascending as the keys are."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def first_key(part: int, parts: int) -> int:
    """The least key that belongs to a part."""
    return -(-(int(part) << 32) // parts) << 32


def _narrow(keys: np.ndarray, low: int, bits: int) -> bytes:
    """Ascending keys as bytes: differences to the one before, in columns of one byte."""
    steps = np.diff(keys >> np.uint64(64 - bits), prepend=np.uint64(low >> 64 - bits))
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return bytes([width]) + steps.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _wide(data: bytes, low: int, bits: int) -> np.ndarray:
    width = data[0]
    steps = np.zeros((len(data) // width, 8), np.uint8)
    steps[:, :width] = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1).T
    keys = np.cumsum(steps.view(np.uint64).ravel(), dtype=np.uint64) + np.uint64(low >> 64 - bits)
    return keys << np.uint64(64 - bits)


def _numbers(values: np.ndarray) -> bytes:
    """Whole numbers as one byte each; those that need more follow with their places."""
    large = np.flatnonzero(values >= 255)
    head = np.array([len(values)], "<u8").tobytes()
    return head + np.minimum(values, 255).astype("u1").tobytes() + large.astype("<u4").tobytes() + values[large].astype("<u8").tobytes()


def _read(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, "<u8", 1)[0])
    values = np.frombuffer(data, "u1", n, 8).astype(np.int64)
    large = (len(data) - 8 - n) // 12
    values[np.frombuffer(data, "<u4", large, 8 + n)] = np.frombuffer(data, "<u8", large, 8 + n + 4 * large)
    return values


def with_target(docs: DataFrame, chosen: DataFrame, id_column: str) -> DataFrame:
    """Documents with ``__target``: whether their id is among the chosen ones."""
    chosen = materialize(chosen.select(id_column).where(F.col(id_column).isNotNull()).distinct())
    few = chosen.count() <= BROADCAST_LABELS
    marked = chosen.withColumn("__target", F.lit(True))
    joined = docs.join(F.broadcast(marked) if few else marked, id_column, "left")
    return joined.withColumn("__target", F.coalesce("__target", F.lit(False)))


def text_bytes(docs: DataFrame, text: str) -> int:
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def block_count(size: int, block_bytes: int) -> int:
    """Blocks of about so many bytes, and larger ones where answers would fall below some
    hundred bytes, since every block asks every part."""
    return max(1, math.ceil(min(size / block_bytes, math.sqrt(size / 600))))


def packed(rows: DataFrame) -> DataFrame:
    """``block, rows``: compressed Arrow tables of ``id, text, target``, some for each block."""

    def pack(held: pa.Table) -> tuple[list[int], list[bytes]]:
        blocks, blobs = [], []
        held = held.combine_chunks().sort_by("block")
        numbers = held["block"].to_numpy()
        cuts = np.flatnonzero(np.diff(numbers)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(numbers)]):
            sink = pa.BufferOutputStream()
            part = held.slice(a, b - a).drop_columns(["block"])
            with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(part)
            blocks.append(int(numbers[a]))
            blobs.append(sink.getvalue().to_pybytes())
        return blocks, blobs

    def work(batches):
        held, size = [], 0
        for columns in batches:
            for start in range(0, len(columns[0]), 1024):
                part = pa.table([c.slice(start, 1024) for c in columns], names=["id", "text", "target", "block"])
                held.append(part)
                size += part["text"].nbytes
                if size >= HELD_BYTES:
                    yield pack(pa.concat_tables(held))
                    held, size = [], 0
        if size or held:
            yield pack(pa.concat_tables(held))

    return map_rows(rows, ["id", "text", "target", "block"], work, "block int, rows binary")


def unpacked(blobs: pd.Series) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(blob).read_all() for blob in blobs])


def cross_entropy_difference(
    docs: DataFrame, target: DataFrame, id_column: str = "doc_id", text: str = "text",
    mu: float = MU, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``id, n_tokens, target_loss, background_loss, difference`` of every row.

    ``target`` lists the ids of the documents that the target model is made from, the background
    model is made from all others. Losses are mean negative logarithms per token, the end of the
    text included; the lower the difference, the more a text is like the target. The counts of a
    document itself are left out where it is scored, so that membership earns nothing. A null
    text counts as empty; a text without words has no tokens and null losses. All rows are counted
    and scored, repeated ones each for itself.
    """
    size = text_bytes(docs, text)
    blocks, bits = block_count(size, block_bytes), min(64, 24 + max(size, 1).bit_length())
    rows = with_target(docs.select(id_column, text), target, id_column)
    block = F.pmod(F.xxhash64(id_column, text), F.lit(blocks)).cast("int").alias("block")
    rows = packed(rows.select(F.col(id_column).alias("id"), F.col(text).alias("text"), F.col("__target").alias("target"), block))

    def block_of(table: pa.Table) -> Block:
        return Block(table["text"].to_pylist(), table["target"].to_numpy().astype(bool), Words(), bits)

    def request(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        block = block_of(unpacked(frame["rows"]))
        in_target, in_background = block.counts()
        ends = np.searchsorted(part_of(block.keys, blocks), np.arange(blocks + 1))
        mine = block.target[block.owner]
        tokens, out = (int(mine.sum()), int((~mine).sum())), []
        for part, (a, b) in enumerate(zip(ends, ends[1:])):
            if b > a:
                sent = _narrow(block.keys[a:b], first_key(part, blocks), bits)
                out.append((part, key[0], sent, _numbers(in_target[a:b]), _numbers(in_background[a:b]), *tokens))
                tokens = 0, 0  # the first request of a block carries its sums
        return pd.DataFrame(out, columns=["part", "block", "keys", "in_target", "in_background", "target_tokens", "background_tokens"])

    def answer(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        asked = [_wide(k, first_key(key[0], blocks), bits) for k in frame["keys"]]
        keys, place = np.unique(np.concatenate(asked), return_inverse=True)
        ends = np.cumsum([0, *map(len, asked)])
        out = frame[["block", "target_tokens", "background_tokens"]].assign(part=key[0], words=0)
        words = (keys >> np.uint64(64 - bits)) & np.uint64(1)
        out.iloc[0, out.columns.get_loc("words")] = int(words.sum())
        for name in ("in_target", "in_background"):
            counted = np.concatenate([_read(v) for v in frame[name]])
            total = np.bincount(place, counted, len(keys)).astype(np.int64)
            out[name] = [_numbers(total[place[a:b]]) for a, b in zip(ends, ends[1:])]
        return out

    asked = rows.groupBy("block").applyInPandas(
        request,
        "part int, block int, keys binary, in_target binary, in_background binary, target_tokens long, background_tokens long",
    )
    answers = materialize(asked.groupBy("part").applyInPandas(
        answer, "block int, target_tokens long, background_tokens long, part int, words long, in_target binary, in_background binary"
    ))
    tokens = answers.agg(F.sum("target_tokens"), F.sum("background_tokens"), F.sum("words")).first()
    words = tokens[2] or 0

    def score(key: tuple, frame: pd.DataFrame, answered: pd.DataFrame) -> pd.DataFrame:
        table = unpacked(frame["rows"])
        block = block_of(table)
        losses = []
        if len(block.word):
            own_word, own_pair = block.own(block.word), block.own(block.pair)
            own_history = np.concatenate([[1], own_word[:-1]])
            own_history[block.history == block.start] = 1
            own_size = block.sizes[block.owner]
            answered = answered.sort_values("part")
            for name, total, member in (
                ("in_target", tokens[0], block.target), ("in_background", tokens[1], ~block.target),
            ):
                counts = np.concatenate([_read(v) for v in answered[name]])
                mine = member[block.owner]
                unigram = (counts[block.word] - own_word * mine + 0.5) / (total - own_size * mine + 0.5 * words)
                pair = counts[block.pair] - own_pair * mine
                history = counts[block.history] - own_history * mine
                loss = -np.log((pair + mu * unigram) / (history + mu))
                losses.append(np.bincount(block.owner, loss, len(table)))
        else:
            losses = [np.zeros(len(table))] * 2
        some = block.sizes > 0
        target_loss, background_loss = (np.where(some, s / np.maximum(block.sizes, 1), np.nan) for s in losses)
        out = pd.DataFrame({"id": pd.Series(table["id"].to_pylist(), dtype=object), "n_tokens": block.sizes})
        for name, values in (
            ("target_loss", target_loss), ("background_loss", background_loss),
            ("difference", target_loss - background_loss),
        ):
            out[name] = pd.Series(values, index=out.index).astype(object).where(some, None)
        return out

    counted = answers.select("block", "part", "in_target", "in_background")
    scored = rows.groupBy("block").cogroup(counted.groupBy("block")).applyInPandas(
        score, "id long, n_tokens long, target_loss double, background_loss double, difference double"
    )
    return scored.withColumnRenamed("id", id_column)
