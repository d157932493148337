"""Review analyses.

Inputs: reviews ``id, review, category, aspect, sentiment``, where an id may occur many times;
stop words ``word``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.functions.text import clean, words
from tallywood.operators.aggregates import rows_per
from tallywood.operators.joins import lookup_join
from tallywood.operators.ranking import first_row, nested_top_n

# A word is frequent above this count; so many words are listed per category.
FREQUENT_ABOVE = 500
TOP_WORDS = 5
POSITIVE, NEGATIVE = "positive", "negative"


def tokens(reviews: DataFrame) -> DataFrame:
    """``id, word``: every word of the cleaned text, in no particular order."""
    exploded = reviews.select("id", F.explode(words(clean(F.col("review")))).alias("word"))
    return exploded.where(F.col("word") != "")


def without_stop_words(tokens: DataFrame, stop_words: DataFrame) -> DataFrame:
    """Tokens that the word list does not name."""
    return lookup_join(tokens, stop_words.select("word"), "word", "left_anti")


def clean_tokens(reviews: DataFrame, stop_words: DataFrame) -> DataFrame:
    return without_stop_words(tokens(reviews), stop_words)


def word_frequencies(
    tokens: DataFrame, stop_words: DataFrame | None = None, above: int = FREQUENT_ABOVE
) -> DataFrame:
    """``word, freq`` of the words that occur more than ``above`` times, most frequent first.

    Stop words are removed after counting, from one row per word.
    """
    counts = tokens.groupBy("word").agg(F.count("id").alias("freq")).where(F.col("freq") > above)
    if stop_words is not None:
        counts = counts.join(stop_words.select("word"), "word", "left_anti")
    return counts.orderBy(F.desc("freq"), "word")


def rows_by(reviews: DataFrame, column: str) -> DataFrame:
    """Rows with an id per category or aspect, most frequent first."""
    return rows_per(reviews, column, "id").orderBy(F.desc("n"), column)


def top_aspect(reviews: DataFrame, sentiment: str) -> DataFrame:
    """The aspect with the most rows of one sentiment: ``aspect, total``."""
    counts = rows_per(reviews.where(F.col("sentiment") == sentiment), "aspect", "id", "total")
    return first_row(counts, [F.desc("total"), F.col("aspect")])


def _chosen(sentiment: str | None) -> Column:
    if sentiment is None:
        return F.lit(True)
    return F.coalesce(F.col("sentiment") == sentiment, F.lit(False))


def _review_counts(reviews: DataFrame, sentiment: str | None) -> DataFrame:
    """``id, category, n_review``: reviews of an id and category, those without a category as 0."""
    chosen = reviews.where(F.col("id").isNotNull() & _chosen(sentiment))
    return chosen.groupBy("id", "category").agg(F.count("category").alias("n_review"))


def _summed(words: DataFrame, stop_words: DataFrame | None) -> DataFrame:
    """``category, word, freq``; stop words are removed after counting, from one row per word."""
    counts = words.groupBy("category", "word").agg(F.sum("n").alias("freq"))
    return counts if stop_words is None else without_stop_words(counts, stop_words)


def category_word_counts(
    tokens: DataFrame,
    reviews: DataFrame,
    sentiment: str | None = None,
    stop_words: DataFrame | None = None,
) -> DataFrame:
    """``category, word, freq`` over all pairs of a token and a review with the same id.

    The pairs are never made: reviews are counted per id and category, and a token meets each
    category of its id once, with that count. An id with many tokens is split by the join, and
    words are combined within tasks before they are shuffled. With a sentiment only the reviews of
    that sentiment give categories. Reviews without a category have the frequency 0.
    """
    met = tokens.join(_review_counts(reviews, sentiment), "id")
    return _summed(met.select("category", "word", F.col("n_review").alias("n")), stop_words)


def review_word_counts(
    reviews: DataFrame, sentiment: str | None = None, stop_words: DataFrame | None = None
) -> DataFrame:
    """The same counts for the words of the reviews themselves.

    A review meets the counts of its id as one row with its text, and its words are taken out
    after that and combined within the task, so nothing with a row per word or per id and word is
    shuffled but one row per task, category and word.
    """
    texts = reviews.where(F.col("id").isNotNull()).select("id", "review")
    met = texts.join(_review_counts(reviews, sentiment), "id")
    exploded = met.select("category", F.col("n_review").alias("n"), F.explode(words(clean(F.col("review")))).alias("word"))
    return _summed(exploded.where(F.col("word") != ""), stop_words)


def _nested(counts: DataFrame, n: int) -> DataFrame:
    order = [F.desc("freq"), F.col("word")]
    return nested_top_n(counts, "category", order, n, ["category", "word", "freq"], "words")


def top_words(
    reviews: DataFrame,
    sentiment: str | None = None,
    stop_words: DataFrame | None = None,
    n: int = TOP_WORDS,
) -> DataFrame:
    """``category, words``: the most frequent words per category as an array of structs.

    With a sentiment only the reviews of that sentiment give categories; the tokens are those
    of all reviews with the same id.
    """
    return _nested(review_word_counts(reviews, sentiment, stop_words), n)


def top_words_of_tokens(
    tokens: DataFrame, reviews: DataFrame, sentiment: str | None = None, n: int = TOP_WORDS
) -> DataFrame:
    """The same for tokens that were stored before, stop words already removed."""
    return _nested(category_word_counts(tokens, reviews, sentiment), n)
