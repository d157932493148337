"""Encoding texts by the words between their spaces, each of which is encoded once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

Ids = tuple[np.ndarray, np.ndarray]


class WordMemory:
    """Cuts texts at single spaces and remembers the ids that ``encode`` finds for the parts.

    ``encode`` takes a list of strings and returns for each the bytes of its ids, numbers of
    ``kind``. It must begin a new piece at every space between two visible characters, as the usual
    byte-level patterns do; then the ids of the parts, each with the space before it, make up those
    of the text. A text in which other white space meets such a space is encoded as a whole.
    ``words`` may do the same faster for an Arrow array of words, each with a space before it: it
    returns the ids of all, one behind the other, and how many each word has.

    Texts are taken in slices of bounded size, and a word is looked up once in a slice. Words and
    ids are kept in arrays; a memory of more than ``remembered`` words keeps those that several
    slices since the last time have had, if they are fewer than half, else those of its last slice.
    """

    SLICE = 2_000_000
    LONGEST = 64

    def __init__(
        self, encode: Callable[[list[str]], list[bytes]], kind: type, remembered: int = 400_000,
        words: Callable[[pa.Array], Ids] | None = None, together: int = SLICE,
    ):
        self.encode, self.kind, self.remembered, self.together = encode, np.dtype(kind), remembered, together
        self.encode_words = words or (lambda found: self._strings([" " + w for w in found.to_pylist()]))
        self._keep(pa.array([], pa.string()), np.zeros(0, self.kind), np.zeros(0, np.int64), np.zeros(0, bool))

    def _keep(self, words: pa.Array, ids: np.ndarray, counts: np.ndarray, again: np.ndarray) -> None:
        self.words, self.ids_of_words, self.counts, self.again = words, ids, counts, again

    def ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text of an Arrow array of strings; none for null and empty texts."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = (np.flatnonzero(np.diff(np.cumsum(sizes) // self.together)) + 1).tolist()
        for start, end in zip([0, *cuts], [*cuts, len(texts)], strict=True):
            if end > start:
                yield from self._slice(texts.slice(start, end - start))

    def _slice(self, texts: pa.Array) -> Iterator[np.ndarray]:
        lists = pc.split_pattern(texts, " ")
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        first = ends - sizes
        parts = lists.flatten()
        # The first part of a text has no space before it, so it is no word like the others.
        firsts, parts = parts.take(pa.array(first)).dictionary_encode(), parts.dictionary_encode()
        words, place = parts.dictionary, parts.indices.to_numpy().astype(np.int64)
        place[first] = len(words) + firsts.indices.to_numpy()
        used = np.zeros(len(words) + len(firsts.dictionary), bool)
        used[place] = True
        sound = np.concatenate([_sound(words, pc.utf8_trim_whitespace), _sound(firsts.dictionary, pc.utf8_rtrim_whitespace)])
        ids, begin, count = self._ids_of(words, (used & sound)[:len(words)], firsts.dictionary, sound[len(words):])
        # Each part is a stretch of the ids of all words of the slice.
        begin, count, alone = begin[place], count[place], np.logical_or.reduceat(~sound[place], first)
        stop = np.cumsum(count)
        found = ids[np.arange(stop[-1]) + np.repeat(begin - stop + count, count)]
        bounds = [0, *stop[ends - 1].tolist()]
        for row, whole in enumerate(alone.tolist()):
            text = texts[row].as_py() if whole else ""
            yield np.frombuffer(self.encode([text])[0], self.kind) if text else found[bounds[row]:0 if whole else bounds[row + 1]]

    def _ids_of(self, words: pa.Array, wanted: np.ndarray, firsts: pa.Array, sound: np.ndarray) -> tuple[np.ndarray, ...]:
        """Ids, and where those of each of the words, and then of the first parts, begin and how many these are."""
        where = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        known, new = np.flatnonzero(wanted & (where >= 0)), np.flatnonzero(wanted & (where < 0))
        fresh = words.take(pa.array(new))
        (ids, counts), (first_ids, first_counts) = self.encode_words(fresh), self._strings(firsts.filter(pa.array(sound)).to_pylist())
        every = np.concatenate([self.ids_of_words, ids, first_ids])
        size = np.concatenate([self.counts, counts, first_counts, np.zeros(1, np.int64)])  # the last for parts without ids
        start, before = np.cumsum(size) - size, len(self.counts)
        row = np.full(len(words) + len(firsts), -1, np.int64)
        row[known], row[new] = where[known], before + np.arange(len(new))
        row[len(words):][sound] = before + len(new) + np.arange(len(first_counts))
        self.again[where[known]] = True
        self._remember(fresh, ids, counts, where[known])
        return every, start[row], size[row]

    def _remember(self, fresh: pa.Array, ids: np.ndarray, counts: np.ndarray, known: np.ndarray) -> None:
        words = pa.concat_arrays([self.words, fresh])
        kept = np.concatenate([np.ones(len(self.words), bool), pc.binary_length(fresh).to_numpy(zero_copy_only=False) <= self.LONGEST])
        again = np.concatenate([self.again, np.zeros(len(fresh), bool)])
        if len(words) > self.remembered:
            last = np.arange(len(words)) >= len(self.words)
            last[known] = True
            kept &= again if again.sum() < self.remembered // 2 else last
            again = np.zeros(len(words), bool)
        counts = np.concatenate([self.counts, counts])
        ids = np.concatenate([self.ids_of_words, ids])[np.repeat(kept, counts)]
        self._keep(words.filter(pa.array(kept)), ids, counts[kept], again[kept])

    def _strings(self, strings: list[str]) -> Ids:
        found = self.encode(strings) if strings else []
        return np.frombuffer(b"".join(found), self.kind), np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize


def _sound(parts: pa.Array, trim: Callable[[pa.Array], pa.Array]) -> np.ndarray:
    """Which parts have something in them and no white space at the ends that are looked at."""
    whole = pc.and_(pc.equal(trim(parts), parts), pc.greater(pc.binary_length(parts), 0))
    return whole.to_numpy(zero_copy_only=False).astype(bool)
