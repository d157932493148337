import random

import pytest
from conftest import rows

from pyspark.sql import functions as F

from tallywood.functions.text import clean, words
from tallywood.plans import reviews as plans
from tallywood.sinks.text import delimited_lines


def reviews_of(spark, data):
    return spark.createDataFrame(data, "id int, review string, category string, aspect string, sentiment string")


@pytest.mark.parametrize("text, expected", [
    ("Phòng SẠCH", ["phòng", "sạch"]), ("cách 10km và 5sao", ["cách", "và"]), ("a,b c.d", ["ab", "cd"]),
    ("2ố đẹp", ["đẹp"]), ("wifi5g x2", ["wifig", "x"]), ("", []), (" 12 ,. ", []), ("one\r\ntwo\n\nthree", ["one", "two", "three"]),
    ("tab\tstays", ["tab\tstays"]), ("( \"quoted\" * )", ["quoted"]),
])
def test_words_of_a_text(spark, text, expected):
    found = plans.tokens(reviews_of(spark, [(1, text, None, None, None)]))
    assert [r[1] for r in rows(found)] == expected


def test_a_missing_text_has_no_words(spark):
    assert rows(plans.tokens(reviews_of(spark, [(1, None, "A", "B", "x")]))) == []


def test_one_pass_gives_the_words_of_three_passes(spark):
    """Line breaks to spaces, then numbers, then punctuation, and no flag on the pattern."""
    text = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    plain = F.regexp_replace(F.lower("text"), r"[\r\n]+", " ")
    plain = F.regexp_replace(F.regexp_replace(plain, r"\b\p{N}+\p{L}*\b", ""), r"[^\p{L}\s]", "")
    three = F.filter(F.split(plain, r'[ ",()*]+'), lambda w: w != "")
    one = F.filter(words(clean(F.col("text"))), lambda w: w != "")
    assert text.where(one != three).count() == 0


@pytest.mark.parametrize("limit", [None, -1])
def test_stop_words(spark, limit):
    stop = spark.createDataFrame([("the",), (None,)], "word string")
    data = reviews_of(spark, [(1, "The cat the dog", "A", "B", "positive"), (2, "THE", "A", "B", "positive")])
    assert sorted(rows(plans.clean_tokens(data, stop))) == [(1, "cat"), (1, "dog")]


def test_frequent_words_above_a_limit(spark):
    data = reviews_of(spark, [(1, "a a a b b c the the the", "A", "B", "x"), (None, "c c c", "A", "B", "x")])
    stop = spark.sql("SELECT word FROM VALUES ('the') AS t(word)")
    assert rows(plans.word_frequencies(plans.tokens(data), stop, above=1)) == [("a", 3), ("b", 2)]


def test_rows_without_an_id_are_not_counted(spark):
    data = reviews_of(spark, [(1, "", "A", "p", "positive"), (1, "", "A", "q", "negative"), (None, "", "header", "h", "s"),
                              (2, "", None, "p", "positive")])
    assert rows(plans.rows_by(data, "category")) == [("A", 2), (None, 1), ("header", 0)]
    assert rows(plans.rows_by(data, "aspect")) == [("p", 2), ("q", 1), ("h", 0)]


def test_top_aspect_with_a_tie(spark):
    data = reviews_of(spark, [(i, "", "A", aspect, "positive") for i, aspect in enumerate("qqppr")])
    assert rows(plans.top_aspect(data, "positive")) == [("p", 2)]
    assert rows(plans.top_aspect(data, "negative")) == []


def random_reviews(spark, seed, n=200):
    """A third of the rows share one id."""
    rng = random.Random(seed)
    vocabulary = [f"w{chr(97 + i)}" for i in range(12)]
    return reviews_of(spark, [(
        0 if i % 3 == 0 else rng.choice([None, *range(1, 30)]),
        " ".join(rng.choices(vocabulary, k=rng.randint(0, 8))),
        rng.choice(["A", "B", None]), "x", rng.choice(["positive", "negative", "neutral"])) for i in range(n)])


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("sentiment", [None, "positive"])
def test_counts_equal_the_plain_join(spark, seed, sentiment):
    data = random_reviews(spark, seed)
    chosen = data if sentiment is None else data.where(F.col("sentiment") == sentiment)
    tokens = plans.tokens(data)
    plain = tokens.join(chosen.select("id", "category"), "id").groupBy("category", "word").agg(F.count("category").alias("freq"))
    expected = sorted(rows(plain), key=str)
    for found in (plans.review_word_counts(data, sentiment), plans.category_word_counts(tokens, data, sentiment)):
        assert sorted(rows(found), key=str) == expected


def test_an_id_with_many_categories_and_words(spark):
    """300 categories times 500 words of one id, counted without making the pairs."""
    words = " ".join("w" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(500))
    data = reviews_of(spark, [(1, words if i == 0 else "", f"c{i}", "x", "positive") for i in range(300)])
    counted = plans.review_word_counts(data)
    assert counted.count() == 150_000 and rows(counted.agg(F.max("freq"), F.min("freq"))) == [(1, 1)]


def test_top_words_are_ordered_and_nested(spark):
    data = reviews_of(spark, [(1, "b a a c", "A", "x", "positive"), (1, "a", "B", "x", "negative")])
    top = plans.top_words(data, n=2)
    assert sorted(rows(top)) == sorted(rows(plans.top_words_of_tokens(plans.tokens(data), data, n=2)))
    assert sorted(rows(delimited_lines(top))) == [("A,{(A,a,3),(A,b,1)}",), ("B,{(B,a,3),(B,b,1)}",)]


def test_sentiments_do_not_exceed_the_total(spark):
    data = random_reviews(spark, 3)
    tokens = plans.tokens(data)
    counts = {s: {(r[0], r[1]): r[2] for r in rows(plans.category_word_counts(tokens, data, s))}
              for s in (None, "positive", "negative")}
    for key, freq in counts[None].items():
        assert counts["positive"].get(key, 0) + counts["negative"].get(key, 0) <= freq


def test_long_stop_list_gives_the_same_words(spark):
    data = random_reviews(spark, 4)
    short = spark.sql("SELECT word FROM VALUES ('wa'), ('wb') AS t(word)")
    long = spark.createDataFrame([("wa",), ("wb",)], "word string")  # of unknown size
    for count in (lambda s: plans.review_word_counts(data, None, s),
                  lambda s: plans.category_word_counts(plans.tokens(data), data, None, s)):
        found = [sorted(rows(count(s)), key=str) for s in (short, long)]
        assert found[0] == found[1] and not {"wa", "wb"} & {r[1] for r in found[0]}
