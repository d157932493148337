"""Language of texts: scripts narrow the candidates, Viterbi over words labels the spans.

Every word has a score in each language, the logarithm of its probability under counts of
character triples. A path through the words of a text pays a penalty where it changes the
language, so single foreign words stay within a span and longer passages get one of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.llm.common import map_rows, slices

UNDETERMINED = "und"
# Documents of each language that the model is fitted on, chosen by the hash of their id.
SAMPLE = 1500
# Cost of changing the language between two words, in nats.
SWITCH = 10.0
# A language is a candidate for a script if this share of its sampled letters is written in it.
SCRIPT_SHARE = 0.01
FORBIDDEN = -60.0

# First and last code point of the blocks of scripts.
SCRIPTS = [
    ("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF), ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF),
    ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF),
    ("hangul", 0x1100, 0x11FF), ("hangul", 0xAC00, 0xD7AF),
]
WORD = regex.compile(r"\p{L}+")
_STARTS = np.array([start for _, start, _ in sorted(SCRIPTS, key=lambda s: s[1])])
_ENDS = np.array([end for _, _, end in sorted(SCRIPTS, key=lambda s: s[1])])
_NAMES = sorted({name for name, _, _ in SCRIPTS})
_NUMBERS = np.array([_NAMES.index(name) for name, _, _ in sorted(SCRIPTS, key=lambda s: s[1])])


def scripts_of(points: np.ndarray) -> np.ndarray:
    """Number of the script of each code point; the number after the last one for others."""
    place = np.maximum(np.searchsorted(_STARTS, points, "right") - 1, 0)
    inside = (points >= _STARTS[place]) & (points <= _ENDS[place])
    return np.where(inside, _NUMBERS[place], len(_NAMES))


def _triples(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the character triples of words with their borders, and each word's first triple."""
    points = np.frombuffer("".join(f"\2{w}\3" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = (points[:-2].astype(np.int64) << 42) | (points[1:-1].astype(np.int64) << 21) | points[2:]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 2)
    keep = np.ones(len(codes), bool)
    keep[ends[:-1] - 2] = keep[ends[:-1] - 1] = False
    return codes[keep], np.cumsum(sizes) - sizes


@dataclass
class LanguageModel:
    """Sorted triple codes with their score in each language, and the languages of each script."""

    languages: list[str]
    codes: np.ndarray
    scores: np.ndarray
    unseen: np.ndarray
    candidates: np.ndarray

    def word_scores(self, words: list[str]) -> np.ndarray:
        """One row per word: its score in each language, forbidden where the script rules it out."""
        codes, first = _triples(words)
        place = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        rows = np.where((self.codes[place] == codes)[:, None], self.scores[place], self.unseen)
        total = np.add.reduceat(rows, first, axis=0)
        scripts = scripts_of(np.fromiter((ord(w[0]) for w in words), np.int64, len(words)))
        allowed = self.candidates[scripts]
        # A script that no language was learned in says nothing about the language.
        return np.where(allowed.any(axis=1)[:, None], np.where(allowed, total, total + FORBIDDEN), 0.0)


def fit(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", language: str = "lang",
    sample: int = SAMPLE,
) -> LanguageModel:
    """A model of the languages of ``docs``, fitted on about ``sample`` texts of each.

    Rows without language or text do not count. A language with more rows takes those whose id
    has a hash below the share that makes ``sample`` rows expected, so every run takes the same
    ones; no text is shuffled. The counts of triples, one row for each triple and language of the
    sample, are all that reaches the driver.
    """
    known = docs.select(id_column, text, language).where(F.col(language).isNotNull() & F.col(text).isNotNull())
    sizes = known.groupBy(language).agg(F.count("*").alias("__n"))  # one row per language
    drawn = F.pmod(F.xxhash64(id_column), F.lit(1 << 30)) * F.col("__n") < sample * (1 << 30)
    chosen = known.join(F.broadcast(sizes), language).where(drawn)

    def count(batches):
        for languages, texts in batches:
            found: dict[tuple, int] = {}
            for lang, value in zip(languages.to_pylist(), texts.to_pylist(), strict=True):
                words = WORD.findall(value.lower())
                if words:
                    codes, times = np.unique(_triples(words)[0], return_counts=True)
                    for code, n in zip(codes.tolist(), times.tolist(), strict=True):
                        found[lang, code] = found.get((lang, code), 0) + n
            keys = list(found)
            yield [k[0] for k in keys], [k[1] for k in keys], list(found.values())

    counted = map_rows(chosen, [language, text], count, "lang string, code long, n long")
    rows = counted.groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows["lang"].unique())
    codes = np.unique(rows["code"].to_numpy(np.int64))
    counts = np.zeros((len(codes), len(languages)))
    for column, lang in enumerate(languages):
        own = rows[rows["lang"] == lang]
        counts[np.searchsorted(codes, own["code"].to_numpy(np.int64)), column] = own["n"]
    totals = counts.sum(axis=0) + 0.5 * (len(codes) + 1)
    scripts = scripts_of((codes >> 21) & 0x1FFFFF)
    letters = np.array([counts[scripts == s].sum(axis=0) for s in range(len(_NAMES) + 1)])
    candidates = letters > SCRIPT_SHARE * counts.sum(axis=0)
    return LanguageModel(languages, codes, np.log((counts + 0.5) / totals), np.log(0.5 / totals), candidates)


def viterbi(scores: np.ndarray, sizes: np.ndarray, switch: float) -> np.ndarray:
    """Language number of each word on the best paths; texts lie one behind the other.

    All texts advance together, word by word, the longest first, so that a step works on those
    that still have words. Ties keep the language, then take the first one.
    """
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    starts, longest = starts[order], int(sizes.max(initial=0))
    alive = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(longest), "right")
    width = scores.shape[1]
    came = np.tile(np.arange(width, dtype=np.min_scalar_type(max(width - 1, 0))), (len(scores), 1))
    best = np.zeros((len(sizes), width))
    final = np.zeros(len(sizes), np.int64)
    for t in range(longest):
        n = alive[t]
        words = starts[:n] + t
        now = best[:n]
        if t:
            top = now.argmax(axis=1)
            other = now[np.arange(n), top][:, None] - switch
            change = other > now
            if change.any():
                came[words] = np.where(change, top[:, None], np.arange(width))
                now = np.where(change, other, now)
        now = now + scores[words]
        best[:n] = now
        ending = alive[t + 1] if t + 1 < longest else 0
        final[ending:n] = now[ending:n].argmax(axis=1)
    labels = np.zeros(len(scores), np.int64)
    current = final.copy()
    for t in range(longest - 1, -1, -1):
        n = alive[t]
        words = starts[:n] + t
        labels[words] = current[:n]
        current[:n] = came[words, current[:n]]
    return labels


class Labeller:
    """Labels batches of texts and remembers the scores of the words it has seen."""

    WORDS = 150_000

    def __init__(self, model: LanguageModel, switch: float):
        self.model, self.switch = model, switch
        self.place: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)))

    def label(self, texts: list[str | None]):
        """Of each text the language, its score and its spans."""
        found = [WORD.findall(text.lower()) if text else [] for text in texts]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        if not self.model.languages or not sizes.sum():
            yield from ((UNDETERMINED, 0.0, None) for _ in texts)
            return
        if len(self.place) > self.WORDS:
            self.place, self.scores = {}, self.scores[:0]
        place = self.place
        new = list({w for words in found for w in words if w not in place})
        if new:
            self.scores = np.concatenate([self.scores, self.model.word_scores(new)])
            for word in new:
                place[word] = len(place)
        words = np.fromiter((place[w] for ws in found for w in ws), np.int64, int(sizes.sum()))
        letters = np.fromiter((len(w) for ws in found for w in ws), np.int64, len(words))
        scores = self.scores[words]
        labels = viterbi(scores, sizes, self.switch)
        width = len(self.model.languages)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        share = np.bincount(owner * width + labels, letters, len(sizes) * width).reshape(-1, width)
        top = share.argmax(axis=1)
        # How much better the words of its spans are explained by the language than by others.
        own = np.where((labels == top[owner])[:, None], scores, 0.0)
        total = np.stack([np.bincount(owner, own[:, k], len(sizes)) for k in range(width)], axis=1)
        margin = np.minimum(total - total[np.arange(len(sizes)), top][:, None], 0.0)
        sure = 1.0 / np.exp(margin).sum(axis=1)
        part = share[np.arange(len(sizes)), top] / np.maximum(share.sum(axis=1), 1)
        cuts = np.flatnonzero((np.diff(owner) != 0) | (np.diff(labels) != 0)) + 1
        first = np.concatenate([[0], cuts]) if len(words) else cuts
        spans: list[list[str]] = [[] for _ in texts]
        begin = np.cumsum(sizes) - sizes
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(words)], strict=True):
            row = int(owner[a])
            spans[row].append(f"{a - begin[row]}-{b - begin[row]}:{self.model.languages[labels[a]]}")
        for row in range(len(texts)):
            if sizes[row]:
                yield self.model.languages[top[row]], float(part[row] * sure[row]), " ".join(spans[row])
            else:
                yield UNDETERMINED, 0.0, None


def predict(
    docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text: str = "text",
    keep: tuple[str, ...] = (), switch: float = SWITCH,
    names: tuple[str, str, str] = ("lang_pred", "score", "spans"),
) -> DataFrame:
    """``id, lang_pred, score, spans`` of every text, and the columns to ``keep``.

    ``names`` renames the three new columns, for inputs that have such names of their own.

    ``spans`` lists the runs of words of one language as ``from-to:language``. ``score`` is the
    share of the letters in spans of the language, times the probability of the language for
    those spans. A text without letters, empty or null, is ``und`` with score 0 and no spans, and
    so is every text if nothing was learned. One map; repeated rows give a row each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # grows with the sample only
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    columns = [id_column, *[c for c in keep if c != id_column]]

    def work(batches):
        labeller = Labeller(shared.value, switch)
        for *kept, texts in batches:
            rows = [row for part in slices(texts) for row in labeller.label(part)]
            yield *kept, [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]

    new = zip(names, ("string", "double", "string"), strict=True)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in columns] + [f"`{n}` {k}" for n, k in new])
    rows = docs.select(*columns, F.col(text).alias("__text"))
    return map_rows(rows, [*columns, "__text"], work, schema)
