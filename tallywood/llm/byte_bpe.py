"""Byte-level BPE by prefix dynamic programming.

Of all encodings of a byte string, byte-pair merging yields one, and so it has one last token for
every prefix of the string. A token that ends at a byte is that last token if it is the first
token of the prefix or may stand behind the last token of what precedes it. Whether two tokens
may stand side by side depends on the two alone, so the answer is kept per pair. The stored last
tokens allow exact appends, and after an edit only the part behind it is computed again, up to
the point from where the old and new prefixes agree.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallywood.llm.common import map_rows
from tallywood.llm.word_memory import WordMemory

# Words whose tokens a Python worker remembers.
REMEMBERED_WORDS = 200_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file: a base64 token and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Prefixes:
    """A byte string with the last token of each of its prefixes (place 0 is unused)."""

    def __init__(self, data: bytes, last: list[int]):
        self.data, self.last = data, last


class PrefixBpe:
    """Encoder and decoder for a rank table whose ids are the merge order.

    ``pattern`` cuts a text into pieces that are encoded one by one; without it the whole text is
    one piece. A piece that is a token as a whole becomes that token.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str | None = None):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no token for the bytes {missing[:5]}")
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.never = max(self.token) + 1
        self.pattern = regex.compile(pattern) if pattern else None
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._words: dict[str, list[int]] = {}

    def _merged_from(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for bytes and tokens no merge makes."""
        if token not in self._parts:
            parts = [self.token[token][i:i + 1] for i in range(len(self.token[token]))]
            while len(parts) > 2:
                options = [(self.ranks.get(a + b, token), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
                rank, i = min(options)
                if rank >= token:
                    break
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            self._parts[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self._parts[token]

    def _made(self, token: int) -> bool:
        return len(self.token[token]) == 1 or self._merged_from(token) is not None

    def side_by_side(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes of two tokens leaves exactly these two.

        Merges run in the order of their ids, the leftmost first. Going back in time, the younger
        of the two tokens at the border falls into its parts. The two stay apart if at no moment
        the neighbours at the border had a merge that was due before the next one on record.
        """
        pair = (left, right)
        known = self._pairs.get(pair)
        if known is None:
            known = self._pairs[pair] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        token, ranks = self.token, self.ranks
        due = self.never
        while True:
            merged = ranks.get(token[left] + token[right])
            if merged is not None and merged < due:
                return False
            born_left = left if len(token[left]) > 1 else -1
            born_right = right if len(token[right]) > 1 else -1
            if born_left < 0 and born_right < 0:
                return True
            if born_left > born_right:
                due, left = left, self._merged_from(left)[1]
            else:
                # Of equal merges the left one runs first, so one like this would still come first.
                due, right = right + 1, self._merged_from(right)[0]

    def _extend(self, data: bytes, last: list[int], stop: int) -> None:
        """Last tokens for the prefixes from ``len(last)`` to ``stop`` bytes."""
        ranks, longest, pairs = self.ranks, self.longest, self._pairs
        for end in range(len(last), stop + 1):
            for start in range(max(0, end - longest), end):
                token = ranks.get(data[start:end])
                if token is None:
                    continue
                if start == 0:
                    if self._made(token):
                        break
                    continue
                before = last[start]
                fits = pairs.get((before, token))
                if fits is None:
                    fits = self._made(token) and self.side_by_side(before, token)
                    pairs[before, token] = fits
                if fits:
                    break
            last.append(token)

    def prefixes(self, data: bytes) -> Prefixes:
        last = [-1]
        self._extend(data, last, len(data))
        return Prefixes(data, last)

    def append(self, known: Prefixes, more: bytes) -> Prefixes:
        """The prefixes of the longer string; those of the old one are taken over."""
        data, last = known.data + more, list(known.last)
        self._extend(data, last, len(data))
        return Prefixes(data, last)

    def edit(self, known: Prefixes, start: int, end: int, new: bytes) -> Prefixes:
        """The prefixes after the bytes from ``start`` to ``end`` are replaced by ``new``.

        Prefixes before the edit stay. Behind it, as soon as as many last tokens in a row agree
        with the old ones as the longest token has bytes, all further ones agree as well, because
        a last token depends on no more than those.
        """
        data = known.data[:start] + new + known.data[end:]
        last, shift, same = known.last[:start + 1], len(new) - (end - start), 0
        while len(last) <= len(data):
            place = len(last)
            self._extend(data, last, place)
            if place - len(new) > start and last[place] == known.last[place - shift]:
                same += 1
                if same >= self.longest:
                    last += known.last[place - shift + 1:]
            else:
                same = 0
        return Prefixes(data, last)

    def tokens(self, known: Prefixes) -> list[int]:
        """The encoding, read back from the last token to the first."""
        whole = self.ranks.get(known.data)
        if whole is not None:
            return [whole]
        found, end = [], len(known.data)
        while end:
            found.append(known.last[end])
            end -= len(self.token[known.last[end]])
        return found[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.tokens(self.prefixes(piece))

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; none for a null or empty text."""
        if not text:
            return []
        pieces = self.pattern.findall(text) if self.pattern else [text]
        return [token for piece in pieces for token in self.encode_piece(piece.encode())]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class ManyWords:
    """The same computation for many short words at once, one array operation per byte.

    Row by row it fills the same table of last tokens as ``PrefixBpe``. Tokens are found by the
    hash of a substring, and a word whose tokens do not spell it is encoded anew without hashes;
    verdicts on pairs are kept in a table that each new pair may overwrite.
    """

    WIDEST = 48
    MEMORY = 1 << 20
    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, bpe: PrefixBpe):
        self.bpe = bpe
        size = bpe.never
        self.length = np.zeros(size, np.int64)
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        merges = {}
        for rank, token in bpe.token.items():
            self.length[rank] = len(token)
            if len(token) > 1:
                parts = bpe._merged_from(rank)
                if parts:
                    self.left[rank], self.right[rank] = parts
                for cut in range(1, len(token)):
                    a, b = bpe.ranks.get(token[:cut]), bpe.ranks.get(token[cut:])
                    if a is not None and b is not None:
                        merges[a * size + b] = rank
        self.made = (self.length == 1) | (self.left >= 0)
        self.pair_keys = np.array(sorted(merges), np.int64)
        self.pair_token = np.array([merges[k] for k in self.pair_keys.tolist()], np.int64)
        powers = [1]
        for _ in range(max(self.WIDEST, bpe.longest)):
            powers.append(powers[-1] * int(self.FACTOR) % 2**64)
        self.powers = np.array(powers, np.uint64)
        ranks = [rank for rank in bpe.token if self.made[rank]]
        hashes = np.array([self._hash(bpe.token[rank]) for rank in ranks], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.by_hash = hashes[order], np.array(ranks, np.int64)[order]
        self.known, self.verdict = np.full(self.MEMORY, -1, np.int64), np.zeros(self.MEMORY, bool)

    def _hash(self, token: bytes) -> int:
        value = 0
        for byte in token:
            value = (value * int(self.FACTOR) + byte + 1) % 2**64
        return value

    def _token_of(self, hashes: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[place] == hashes, self.by_hash[place], -1)

    def _fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.bpe.never + right
        place = ((keys.view(np.uint64) * self.FACTOR) >> np.uint64(44)).astype(np.int64)
        fits = self.verdict[place]
        new = self.known[place] != keys
        if new.any():
            fresh, inverse = np.unique(keys[new], return_inverse=True)
            found = self._stay_apart(fresh // self.bpe.never, fresh % self.bpe.never)
            fits[new] = found[inverse]
            place = ((fresh.view(np.uint64) * self.FACTOR) >> np.uint64(44)).astype(np.int64)
            # One write of a place for both tables, so that key and verdict belong together.
            _, last = np.unique(place[::-1], return_index=True)
            last = len(place) - 1 - last
            self.known[place[last]], self.verdict[place[last]] = fresh[last], found[last]
        return fits

    def _stay_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        left, right = left.copy(), right.copy()
        due = np.full(len(left), self.bpe.never, np.int64)
        result, open_ = np.zeros(len(left), bool), np.arange(len(left))
        while len(open_):
            a, b = left[open_], right[open_]
            keys = a * self.bpe.never + b
            place = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            merges = (self.pair_keys[place] == keys) & (self.pair_token[place] < due[open_])
            born_a, born_b = np.where(self.length[a] > 1, a, -1), np.where(self.length[b] > 1, b, -1)
            bytes_only = (born_a < 0) & (born_b < 0)
            result[open_[bytes_only & ~merges]] = True
            more = ~merges & ~bytes_only
            open_, a, b, undo_left = open_[more], a[more], b[more], (born_a > born_b)[more]
            due[open_] = np.where(undo_left, a, b + 1)
            left[open_] = np.where(undo_left, self.right[a], a)
            right[open_] = np.where(undo_left, b, self.left[b])
        return result

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Tokens of each word; no word may be longer than ``WIDEST`` bytes."""
        sizes = np.array([len(w) for w in words], np.int64)
        found: list[list[int]] = [[]] * len(words)
        order = np.argsort(sizes, kind="stable")
        step = 20_000
        for at in range(0, len(order), step):
            rows = order[at:at + step]
            for row, tokens in zip(rows.tolist(), self._encode([words[r] for r in rows], sizes[rows]), strict=True):
                spelled = self.bpe.decode(tokens) == words[row]
                found[row] = tokens if spelled else self.bpe.encode_piece(words[row])
        return found

    def _encode(self, words: list[bytes], sizes: np.ndarray) -> list[list[int]]:
        n, width = len(words), int(sizes.max())
        data = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        prefix = np.zeros((width + 1, n), np.uint64)
        for end in range(1, width + 1):
            prefix[end] = prefix[end - 1] * self.FACTOR + data[:, end - 1] + np.uint64(1)
        last = np.full((width + 1, n), -1, np.int64)
        for end in range(1, width + 1):
            open_ = np.arange(np.searchsorted(sizes, end), n)  # the words are in order of length
            for start in range(end - 1, max(0, end - self.bpe.longest) - 1, -1):
                hashes = prefix[end, open_] - prefix[start, open_] * self.powers[end - start]
                token = self._token_of(hashes)
                hit = np.flatnonzero(token >= 0)
                if start and len(hit):
                    hit = hit[self._fit(last[start, open_[hit]], token[hit])]
                if len(hit):
                    last[end, open_[hit]] = token[hit]
                    open_ = np.delete(open_, hit)
                    if not len(open_):
                        break
        place, rows, steps = sizes.copy(), np.arange(n), []
        while len(rows):
            token = last[place[rows], rows]
            steps.append((rows, token))
            place[rows] -= self.length[token]
            rows = rows[place[rows] > 0]
        owner = np.concatenate([rows for rows, _ in steps][::-1])
        token = np.concatenate([token for _, token in steps][::-1])
        order = np.argsort(owner, kind="stable")
        ends = np.cumsum(np.bincount(owner, minlength=n))
        flat, tokens, begin = token[order].tolist(), [], 0
        for end in ends.tolist():
            tokens.append(flat[begin:end])
            begin = end
        return tokens


class TextEncoder:
    """Encodes batches of texts with a pattern; remembers the words it has seen."""

    def __init__(self, bpe: PrefixBpe):
        self.bpe, self.many = bpe, ManyWords(bpe)
        self.memory = WordMemory(self._ids, np.uint32, REMEMBERED_WORDS)

    def encode(self, texts: pa.Array | list[str | None]) -> Iterator[list[int]]:
        """The ids of each text, one after another."""
        for ids in self.memory.ids(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())):
            yield ids.tolist()

    def _ids(self, strings: list[str]) -> list[bytes]:
        """The ids of strings; their short pieces are encoded together."""
        ranks = self.bpe.ranks
        pieces = [[p.encode() for p in self.bpe.pattern.findall(s)] for s in strings]
        short = list({p for ps in pieces for p in ps if p not in ranks and len(p) <= ManyWords.WIDEST})
        alone = dict(zip(short, self.many.encode(short), strict=True))
        found = []
        for ps in pieces:
            for p in ps:
                if p not in alone:
                    alone[p] = self.bpe.encode_piece(p)
            found.append(array("I", chain.from_iterable(map(alone.__getitem__, ps))).tobytes())
        return found


_OPEN: dict[tuple, TextEncoder] = {}


def _encoder(key: str, shared, pattern: str) -> TextEncoder:
    """One encoder per Python worker, so that its words outlive a task."""
    if (key, pattern) not in _OPEN:
        _OPEN[key, pattern] = TextEncoder(PrefixBpe(shared.value, pattern))
    return _OPEN[key, pattern]


def encode_table(
    docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``id, ids`` of every text, as an array of ids (empty for null and empty texts).

    One map without a shuffle; repeated rows and ids give a row each, other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path))  # the size of the file

    def work(batches):
        encoder = _encoder(path, shared, pattern)
        for ids, texts in batches:
            yield ids, list(encoder.encode(texts))

    return map_rows(docs, [id_column, text], work, f"{id_column} long, ids array<bigint>")


def digest_table(
    docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256, round_trip`` of every text.

    ``ids_sha256`` is the hash of the decimal ids joined by commas and ``decoded_sha256`` that of
    the bytes decoded from the ids; ``round_trip`` tells whether these are the bytes of the text.
    A null text counts as empty. Whole arrays of ids never leave the worker.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def work(batches):
        encoder = _encoder(path, shared, pattern)
        bpe, decimal = encoder.bpe, {rank: b"%d" % rank for rank in encoder.bpe.token}
        for ids, texts in batches:
            counts, hashes, decoded, same = [], [], [], []
            for string, tokens in zip(texts, encoder.encode(texts), strict=True):
                back = bpe.decode(tokens)
                counts.append(len(tokens))
                hashes.append(hashlib.sha256(b",".join(map(decimal.__getitem__, tokens))).hexdigest())
                decoded.append(hashlib.sha256(back).hexdigest())
                same.append(back == (string.as_py() or "").encode())
            yield ids, counts, hashes, decoded, same

    schema = f"{id_column} long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean"
    return map_rows(docs, [id_column, text], work, schema)
