"""Review analyses on the test tables."""

from __future__ import annotations

from tallywood.plans import reviews as plans
from tallywood.session import materialize
from tallywood.sinks.text import delimited_lines
from workload import views
from workload.sql import tokens

TOKENS_SQL = tokens("documents", "doc_id")
TURN_TOKENS_SQL = tokens("conversations", "conv_id")
STOP_SQL = "(SELECT unnest([" + ", ".join(f"'{w}'" for w in views.STOP_WORDS) + "]) AS word)"
KEPT_SQL = f"(SELECT id, word FROM {TOKENS_SQL} WHERE word NOT IN (SELECT word FROM {STOP_SQL}))"
LABELLED_SQL = """(SELECT d.doc_id AS id, d.lang AS category, d.source AS aspect,
  CASE l.quality WHEN 1 THEN 'positive' WHEN 0 THEN 'negative' END AS sentiment
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


def _top_sql(tokens_sql: str, reviews_sql: str) -> str:
    return f"""WITH f AS (SELECT r.category, t.word, count(*) AS freq
  FROM {tokens_sql} t JOIN {reviews_sql} r ON r.id = t.id GROUP BY r.category, t.word),
k AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY freq DESC, word) AS rank FROM f)
SELECT category, word, freq, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= 5"""


def _flat(df):
    """The nested answer as one row per word, with its place in the array."""
    return df.selectExpr("category", "posexplode(words) AS (place, w)").selectExpr(
        "category", "w.word AS word", "w.freq AS freq", "place + 1 AS rank"
    )


def text_tokens(spark, d):
    return plans.tokens(views.reviews(spark, d))


def kept_tokens(spark, d):
    return plans.without_stop_words(text_tokens(spark, d), views.stop_words(spark))


def frequent_words(spark, d):
    return plans.word_frequencies(text_tokens(spark, d), views.stop_words(spark))


def by_category(spark, d):
    return plans.rows_by(views.reviews(spark, d), "category")


def by_aspect(spark, d):
    return plans.rows_by(views.reviews(spark, d), "aspect")


def top_positive(spark, d):
    return plans.top_aspect(views.labelled_reviews(spark, d), plans.POSITIVE)


def top_negative(spark, d):
    return plans.top_aspect(views.labelled_reviews(spark, d), plans.NEGATIVE)


def _top(spark, d, reviews, sentiment=None):
    return plans.top_words(reviews(spark, d), sentiment, views.stop_words(spark))


def top_words(spark, d):
    return _flat(_top(spark, d, views.reviews))


def top_words_positive(spark, d):
    return _flat(_top(spark, d, views.labelled_reviews, plans.POSITIVE))


def top_words_negative(spark, d):
    return _flat(_top(spark, d, views.labelled_reviews, plans.NEGATIVE))


def top_words_stored(spark, d):
    """From tokens stored as a table."""
    stored = materialize(kept_tokens(spark, d))
    return _flat(plans.top_words_of_tokens(stored, views.reviews(spark, d)))


def top_words_text(spark, d):
    """The nested form as bag text."""
    return delimited_lines(_top(spark, d, views.reviews))


def fanout_counts_by_review(spark, d):
    """Turns share ids, so each word meets every turn of its conversation."""
    return plans.review_word_counts(views.turns(spark, d))


def fanout_counts(spark, d):
    """The same from a table of tokens."""
    found = views.turns(spark, d)
    return plans.category_word_counts(plans.tokens(found), found)


def _aspect_sql(sentiment: str) -> str:
    return f"""SELECT aspect, count(id) AS total FROM {LABELLED_SQL} WHERE sentiment = '{sentiment}'
GROUP BY aspect ORDER BY total DESC, aspect LIMIT 1"""


FANOUT_SQL = f"""SELECT r.role AS category, t.word, count(*) AS freq FROM {TURN_TOKENS_SQL} t
JOIN conversations r ON r.conv_id = t.id GROUP BY r.role, t.word"""
ALL_TOP_SQL = _top_sql(KEPT_SQL, LABELLED_SQL)

QUERIES = {
    "text_tokens": (text_tokens, f"SELECT id, word FROM {TOKENS_SQL}"),
    "text_tokens_no_stopwords": (kept_tokens, f"SELECT id, word FROM {KEPT_SQL}"),
    "word_freq_over_n": (
        frequent_words, f"SELECT word, count(*) AS freq FROM {KEPT_SQL} GROUP BY word HAVING count(*) > 500"),
    "rows_by_category": (
        by_category, "SELECT lang AS category, count(doc_id) AS n FROM documents GROUP BY lang"),
    "rows_by_aspect": (
        by_aspect, "SELECT source AS aspect, count(doc_id) AS n FROM documents GROUP BY source"),
    "top_aspect_positive": (top_positive, _aspect_sql("positive")),
    "top_aspect_negative": (top_negative, _aspect_sql("negative")),
    "top5_words_by_category": (top_words, ALL_TOP_SQL),
    "top5_words_positive": (
        top_words_positive, _top_sql(KEPT_SQL, f"(SELECT * FROM {LABELLED_SQL} WHERE sentiment = 'positive')")),
    "top5_words_negative": (
        top_words_negative, _top_sql(KEPT_SQL, f"(SELECT * FROM {LABELLED_SQL} WHERE sentiment = 'negative')")),
    "top5_words_bag_text": (
        top_words_text,
        "SELECT category || ',{' || string_agg('(' || category || ',' || word || ',' || CAST(freq AS VARCHAR) || ')', ',' "
        f"ORDER BY rank) || '}}' AS line FROM ({ALL_TOP_SQL}) GROUP BY category"),
    "top5_words_stored_tokens": (top_words_stored, ALL_TOP_SQL),
    "fanout_word_count": (fanout_counts_by_review, FANOUT_SQL),
    "fanout_word_count_factored": (fanout_counts, FANOUT_SQL),
}
