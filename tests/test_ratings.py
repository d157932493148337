import pytest
from conftest import rows

from tallywood.plans import ratings as plans
from tallywood.plans import reports
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def data(spark):
    ratings = [(u, i, s, 1577836800) for u, i, s in [
        (1, 10, 4.0), (2, 10, 5.0), (3, 10, 4.5), (4, 10, 3.0), (1, 10, 4.0),
        (1, 20, 2.0), (2, 20, 4.0), (9, 20, 1.0), (3, 30, 5.0), (4, 40, 4.0),
    ]]
    items = [(10, "Alpha", ["War", "Drama"]), (20, "Beta", ["Drama"]), (30, "Beta", []), (50, "Unrated", ["War"])]
    users = [(1, "M", 18, "1"), (2, "f", 35, "2"), (3, "m", 50, "7"), (4, "X", 56, "1")]
    return (
        spark.createDataFrame(ratings, "user_id bigint, item_id bigint, score double, ts bigint"),
        spark.createDataFrame(items, "item_id bigint, title string, genres array<string>"),
        spark.createDataFrame(users, "user_id bigint, gender string, age int, occupation_id string"),
        spark.createDataFrame([("1", "Writer"), ("2", "Cook")], "code string, name string"),
    )


def test_items_with_enough_ratings(data):
    ratings, items, _, _ = data
    assert rows(plans.mean_by_item(ratings, items)) == [("Alpha", 4.1, 5)]
    assert rows(plans.mean_by_item(ratings, items, 1)) == [
        ("Beta", 5.0, 1), ("Alpha", 4.1, 5), ("Unknown(40)", 4.0, 1), ("Beta", 2.33, 3)]


def test_best_item_and_empty_input(data):
    ratings, items, _, _ = data
    assert rows(plans.best_item(ratings, items, 3)) == [("Alpha", 4.1, 5)]
    assert rows(plans.best_item(ratings, items, 100)) == []


def test_ties_go_to_more_ratings_then_to_the_first_title(spark):
    ratings = spark.createDataFrame(
        [(1, 1, 4.0, 1), (1, 2, 4.0, 1), (2, 2, 4.0, 1), (1, 3, 4.0, 1), (2, 3, 4.0, 1)],
        "user_id bigint, item_id bigint, score double, ts bigint")
    items = spark.createDataFrame([(1, "A"), (2, "C"), (3, "B")], "item_id bigint, title string")
    assert rows(plans.mean_by_item(ratings, items, 1)) == [("B", 4.0, 2), ("C", 4.0, 2), ("A", 4.0, 1)]
    every = plans.mean_of_every_item(ratings, items)
    assert rows(plans.best_of_every_item(every, 1)) == [(1, "A", 4.0, 1)]


def test_a_repeated_title_does_not_repeat_the_item(spark, data):
    ratings, _, _, _ = data
    items = spark.createDataFrame([(10, "Old", 1), (10, "New", 2)], "item_id bigint, title string, position int")
    assert rows(plans.mean_by_item(ratings, items)) == [("New", 4.1, 5)]


def test_rounding_half_even_on_the_binary_value(spark):
    ratings = spark.createDataFrame([(1, 1, 3.125, 1), (1, 2, 2.675, 1), (1, 3, 3.375, 1)],
                                    "user_id bigint, item_id bigint, score double, ts bigint")
    items = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "item_id bigint, title string")
    assert {r[0]: r[1] for r in rows(plans.mean_by_item(ratings, items, 1))} == {"a": 3.12, "b": 2.67, "c": 3.38}


def test_genres(data):
    ratings, items, _, _ = data
    assert rows(plans.mean_by_genre(ratings, items)) == [("War", 4.1, 5), ("Drama", 27.5 / 8, 8)]


def test_item_gender_drops_unknown_users_and_items(data):
    ratings, items, users, _ = data
    assert rows(plans.mean_by_item_gender(ratings, users, items)) == [
        (10, "Alpha", "M", 4.0, 2), (10, "Alpha", "X", 3.0, 1), (10, "Alpha", "f", 5.0, 1),
        (10, "Alpha", "m", 4.5, 1), (20, "Beta", "M", 2.0, 1), (20, "Beta", "f", 4.0, 1),
        (30, "Beta", "m", 5.0, 1)]


def test_side_by_side_ignores_case_and_groups_by_title(data):
    ratings, items, users, _ = data
    table = plans.gender_side_by_side(ratings, users, items)
    assert rows(table) == [("Alpha", 12.5 / 3, 5.0), ("Beta", 3.5, 4.0)]


def test_title_rated_by_neither_gender_keeps_its_row(spark, data):
    _, items, users, _ = data
    ratings = spark.createDataFrame([(4, 10, 3.0, 1)], "user_id bigint, item_id bigint, score double, ts bigint")
    table = plans.gender_side_by_side(ratings, users, items)
    assert rows(table) == [("Alpha", None, None)]
    assert rows(reports.gender_key_values(table)) == [("Alpha", "Male: N/A, Female: N/A")]


def test_four_bands(data):
    ratings, items, users, _ = data
    table = plans.age_bands_side_by_side(ratings, users, items)
    assert rows(table) == [("Alpha", 4.0, 5.0, 4.5, 3.0), ("Beta", 2.0, 4.0, 5.0, None)]
    assert rows(reports.age_band_key_values(table)) == [
        ("Alpha", "0-18: 4.00 18-35: 5.00 35-50: 4.50 50+: 3.00"),
        ("Beta", "0-18: 2.00 18-35: 4.00 35-50: 5.00 50+: NA")]


def test_seven_bands(data):
    ratings, items, users, _ = data
    first = plans.age_band_table(ratings, users, items).first()
    assert (first["18-24 avg"], first["18-24 n"], first["<18 avg"], first["<18 n"]) == (4.0, 2, None, 0)
    assert (first["35-44 n"], first["50-55 n"], first["56+ avg"]) == (1, 1, 3.0)


def test_wide_and_long_bands_agree(data):
    ratings, items, users, _ = data
    long = {(r[0], r[1]): (r[2], r[3]) for r in rows(plans.mean_by_item_band(ratings, users))}
    for row in plans.age_band_table(ratings, users, items).collect():
        for band in ("<18", "18-24", "25-34", "35-44", "45-49", "50-55", "56+"):
            assert long.get((row["item_id"], band), (None, 0)) == (row[f"{band} avg"], row[f"{band} n"])


def test_occupation_label_and_missing_code(data):
    ratings, _, users, codes = data
    assert rows(plans.mean_by_occupation(ratings, users, codes)) == [
        ("OccupationID_7", 4.75, 2), ("Cook", 4.5, 2), ("Writer", 17.0 / 5, 5)]


def test_years_in_seconds_and_milliseconds(spark):
    stamps = [1577836800, 1577836799, 1577836800000, 999999999999, 10**17, -1, -62135596801]
    ratings = spark.createDataFrame([(float(i), t) for i, t in enumerate(stamps)], "score double, ts bigint")
    assert rows(plans.mean_by_year(ratings)) == [(1969, 5.0, 1), (2019, 1.0, 1), (2020, 1.0, 2)]


def test_counts_by_gender_add_up(data):
    ratings, items, users, _ = data
    known = ratings.join(users, "user_id").join(items, "item_id").count()
    assert plans.mean_by_item_gender(ratings, users, items).agg(F.sum("n_ratings")).first()[0] == known


def test_scores_that_are_not_finite_do_not_end_a_job(spark):
    scores = ["inf", "-inf", "1e400", "nan", "2.345", None]
    ratings = spark.createDataFrame([(i, i, x) for i, x in enumerate(scores)], "user_id int, item_id int, text string")
    ratings = ratings.select("user_id", "item_id", F.expr("CAST(text AS DOUBLE)").alias("score"))
    items = spark.createDataFrame([], "item_id int, title string, genres array<string>")
    found = {r.title: r.avg_rating for r in plans.mean_by_item(ratings, items, 0).collect()}
    assert found["Unknown(0)"] == float("inf") and found["Unknown(1)"] == float("-inf")
    assert found["Unknown(2)"] == float("inf") and found["Unknown(3)"] != found["Unknown(3)"]
    assert found["Unknown(4)"] == 2.35 and found["Unknown(5)"] is None


def test_a_user_without_an_age_has_no_band(spark):
    ratings = spark.createDataFrame([(1, 7, 4.0), (2, 7, 2.0), (2, 8, 2.0)], "user_id int, item_id int, score double")
    users = spark.createDataFrame([(1, "f", 30, "1"), (2, "m", None, "1")], "user_id int, gender string, age int, occupation_id string")
    maps = {r.item_id: r.bands for r in plans.band_map(plans.mean_by_item_band(ratings, users)).collect()}
    assert len(maps[7]) == 1 and maps[8] == {}
