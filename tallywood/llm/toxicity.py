"""Toxicity of texts: boosted trees on dense features, calibrated by isotonic regression."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.llm.common import map_rows, materialize

# Labelled rows that are learned from, those with the least hash of their id.
SAMPLE = 24_000
# A word belongs to the lexicon if in so many toxic texts, and so many times likelier there.
LEAST_TEXTS = 3
LEAST_ODDS = 4.0
LEXICON = 20_000
NEAR = 6

# Second persons, and what signs stand for in disguised words.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch euer sie tu te toi ton ta tes"
    " vous votre vos tú ti tu usted ustedes vosotros vuestro".split()
)
SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"})

EDGES = ".,;:!?\"'()[]{}<>…«»“”„-–—*#%&$"
DISGUISED = re.compile(r"[^\W\d_][0-9@$!*|#._-]+[^\W\d_]")
# Around a token, without the signs that may stand for a letter of it.
OUTER = EDGES.replace("*", "").replace("$", "")
EDGE_DISGUISED = re.compile(r"^[@$|]+[^\W\d_]|[^\W\d_][@$|]+$|^[^\W\d_]+\*\*+$")
EDGE_SIGN = re.compile(r"^[013457@$!|]|[013457@$!|]$")
NOT_ASCII = re.compile(r"[^\x00-\x7f]+")
REPEATED = re.compile(r"([^\W\d_])\1\1")

FEATURES = [
    "lexicon_density", "lexicon_weight_density", "lexicon_texts", "strongest", "near_second_person",
    "second_person_density", "capitals", "shouted_words", "exclamations", "questions", "odd_signs",
    "punctuation", "disguised_words", "disguised_hits", "repeated_letters", "log_words",
]


def words_of(text: str) -> list[str]:
    """Words in lower case without the signs around them, in order; signs alone are left out."""
    return [w for w in (t.strip(EDGES) for t in text.lower().split()) if w]


def edged(token: str, word: str) -> str | None:
    """A token with signs in place of its first or last letters; None if it is just its ``word``."""
    full = token.strip(OUTER)
    if full == word and not EDGE_SIGN.search(full):
        full = token.strip(OUTER.replace("!", ""))
    return full if EDGE_SIGN.search(full) or EDGE_DISGUISED.search(full) else None


def plain(word: str) -> str:
    """A disguised word with letters in place of the signs that stand for them."""
    return re.sub(r"[^\w]|_", "", word.translate(SIGNS))


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """The features of a text in the order of ``FEATURES``; all are 0 for an empty one."""
    tokens = [t for t in text.lower().split() if t.strip(EDGES)] if text else []
    words = [t.strip(EDGES) for t in tokens]
    if not words:
        return [0.0] * len(FEATURES)
    n, letters = len(words), len(text)
    weights = list(map(lexicon.get, words))
    hits = [i for i, w in enumerate(weights) if w is not None]
    found = [weights[i] for i in hits]
    odd = [i for i, w in enumerate(words) if not w.isalpha()]
    at_edges = {i: full for i, t in enumerate(tokens) if not t.isalpha() and (full := edged(t, words[i]))}
    disguised = sorted({i for i in odd if DISGUISED.search(words[i])} | {i for i, t in at_edges.items() if EDGE_DISGUISED.search(t)})
    uncovered = {}
    for i in {*disguised, *at_edges}:
        readings = [plain(w) for w in (at_edges.get(i), words[i]) if w]
        if weights[i] is None and (reading := next((r for r in readings if r in lexicon), None)):
            uncovered[i] = lexicon[reading]
    hits = sorted([*hits, *uncovered])
    found += [uncovered[i] for i in sorted(uncovered)]
    persons = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if persons and hits:
        places = np.array(persons)
        at = np.array(hits)
        after = np.searchsorted(places, at)
        gap = np.minimum(
            np.abs(places[np.minimum(after, len(places) - 1)] - at), np.abs(at - places[np.maximum(after - 1, 0)])
        )
        near = int((gap <= NEAR).sum())
    ascii_counts = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=128)
    others = "" if text.isascii() else "".join(NOT_ASCII.findall(text))
    upper = int(ascii_counts[65:91].sum()) + sum(map(str.isupper, others))
    lower = int(ascii_counts[97:123].sum()) + sum(map(str.islower, others))
    signs = int(ascii_counts[33:48].sum() + ascii_counts[58:65].sum() + ascii_counts[91:97].sum() + ascii_counts[123:127].sum())
    strange = int(ascii_counts[[35, 36, 37, 38, 42, 64, 94, 126]].sum())
    shouted = sum(w.isupper() and len(w) > 2 for w in text.split()) if upper else 0
    return [
        len(hits) / n, sum(found) / n, float(np.log1p(len(hits))), max(found, default=0.0), near / n,
        len(persons) / n, upper / max(upper + lower, 1), shouted / n, int(ascii_counts[33]) / letters,
        int(ascii_counts[63]) / letters, strange / letters, signs / letters, len(disguised) / n,
        len(uncovered) / n, len(REPEATED.findall(text)) / n,
        float(np.log1p(n)),
    ]


class ToxicityModel:
    """Lexicon, trees and calibration; without two classes to learn from, one constant score."""

    def __init__(self, lexicon: dict[str, float], trees: GBTClassificationModel | None, calibration, prior: float):
        self.lexicon, self.trees, self.calibration, self.prior = lexicon, trees, calibration, prior


def learn_lexicon(texts: DataFrame, text: str, label: str) -> dict[str, float]:
    """Words that are much likelier in toxic texts, with the logarithm of how much.

    Of more than ``LEXICON`` words those with the greatest evidence stay.
    """

    def count(batches):
        for labels, strings in batches:
            toxic, clean, sizes = Counter(), Counter(), [0, 0]
            for flag, value in zip(labels.to_pylist(), strings.to_pylist(), strict=True):
                found = set(words_of(value or ""))
                found |= {plain(w) for w in found if not w.isalpha() and DISGUISED.search(w)}
                tokens = {t.strip(OUTER) for t in (value or "").lower().split()}
                found |= {plain(t) for t in tokens if not t.isalpha() and EDGE_DISGUISED.search(t)}
                (toxic if flag else clean).update(found)
                sizes[0 if flag else 1] += 1
            keys = sorted(toxic.keys() | clean.keys())
            yield ["", *keys], [sizes[0], *[toxic[k] for k in keys]], [sizes[1], *[clean[k] for k in keys]]

    rows = map_rows(texts, [label, text], count, "word string, toxic long, clean long")
    rows = rows.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    total = rows.where("word = ''").first()
    if not total or not total["toxic"] or not total["clean"]:
        return {}
    odds = F.log((F.col("toxic") + 0.5) / (total["toxic"] + 1)) - F.log((F.col("clean") + 0.5) / (total["clean"] + 1))
    chosen = rows.where((F.col("word") != "") & (F.col("toxic") >= LEAST_TEXTS)).withColumn("odds", odds)
    chosen = chosen.where(F.col("odds") >= float(np.log(LEAST_ODDS)))
    best = chosen.orderBy(F.desc(F.col("odds") * F.col("toxic")), "word").limit(LEXICON)
    return {r["word"]: r["odds"] for r in best.select("word", "odds").collect()}


def _featured(docs: DataFrame, lexicon: dict[str, float], keep: list[str], text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # at most LEXICON words
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}

    def work(batches):
        for *kept, texts in batches:
            rows = [features(t, shared.value) for t in texts.to_pylist()]
            columns = np.array(rows, float).reshape(len(rows), len(FEATURES)).T
            yield *kept, *columns

    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [f"{name} double" for name in FEATURES])
    rows = map_rows(docs, [*keep, text], work, schema)
    return rows.select(*keep, array_to_vector(F.array(*FEATURES)).alias("features"))


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_column: str = "doc_id",
    text: str = "text", sample: int = SAMPLE,
) -> ToxicityModel:
    """A model from the labelled documents, at most ``sample`` of them, chosen by their id's hash.

    Three separate parts teach the lexicon, the trees and the calibration, so that none of them
    sees rows that the one before it was fitted to. A document with several labels is toxic if
    one of them says so; null labels do not count.
    """
    known = labels.where(F.col(label).isNotNull()).groupBy(id_column).agg(F.max(F.col(label).cast("int")).alias("__label"))
    chosen = known.orderBy(F.xxhash64(id_column), id_column).limit(sample)
    part = F.pmod(F.xxhash64(F.lit("part"), F.col(id_column)), F.lit(5)).alias("__part")
    rows = docs.select(id_column, text).join(F.broadcast(chosen), id_column)  # ``sample`` rows
    rows = materialize(rows.select("__label", part, F.col(text).alias("__text")))
    lexicon = learn_lexicon(rows.where("__part < 2"), "__text", "__label")
    table = materialize(_featured(rows.where("__part >= 2"), lexicon, ["__label", "__part"], "__text"))
    table = table.withColumn("label", F.col("__label").cast("double")).coalesce(4)
    counts = {(r["t"], r["label"]): r["n"] for r in table.groupBy((F.col("__part") < 4).alias("t"), "label").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    prior = sum(n for (_, value), n in counts.items() if value) / total if total else 0.0
    if not counts.get((True, 0.0)) or not counts.get((True, 1.0)):
        return ToxicityModel(lexicon, None, None, prior)
    trees = GBTClassifier(maxIter=25, maxDepth=3, stepSize=0.25, seed=7, minInstancesPerNode=5).fit(table.where("__part < 4"))
    calibration = None
    if counts.get((False, 0.0)) and counts.get((False, 1.0)):
        scored = _raw(table.where("__part = 4"), trees)
        calibration = IsotonicRegression(featuresCol="__raw", predictionCol="__calibrated").fit(scored)
    return ToxicityModel(lexicon, trees, calibration, prior)


def _raw(rows: DataFrame, trees: GBTClassificationModel) -> DataFrame:
    out = trees.transform(rows)
    return out.withColumn("__raw", vector_to_array("probability")[1])


def score(
    docs: DataFrame, model: ToxicityModel, keep: tuple[str, ...] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """The columns to keep with ``score`` (0 to 1) and ``predicted`` (1 from a score of 0.5).

    Null and empty texts have a score as well, that of a text without words. One map.
    """
    rows = _featured(docs, model.lexicon, list(keep), text)
    value = F.lit(model.prior)
    if model.trees is not None:
        rows, value = _raw(rows, model.trees), F.col("__raw")
        if model.calibration is not None:
            rows = model.calibration.transform(rows)
            # Calibration has steps; a little of the raw score keeps the order within a step.
            value = 0.98 * F.col("__calibrated") + 0.02 * F.col("__raw")
    value = F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))
    return rows.select(*keep, value.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
