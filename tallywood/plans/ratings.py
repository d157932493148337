"""Rating analyses.

Inputs: ratings ``user_id, item_id, score, ts``; items ``item_id, title, genres``; users
``user_id, gender, age, occupation_id``; codes ``code, name``.

Ratings are summed per item or per user before they meet a dimension, so a popular item or a
busy user reaches the join as a single row. Where both user attribute and item are needed, the
ratings go through ``lookup_join``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.functions.bands import (
    FOUR_BANDS,
    SEVEN_BANDS,
    band_conditions,
    band_of,
    label_or,
    same_letter,
)
from tallywood.functions.dates import epoch_year
from tallywood.functions.numbers import round_half_even
from tallywood.operators.aggregates import (
    COUNT,
    cell_mean,
    cell_totals,
    combined,
    combined_cells,
    mean_and_count,
    totals,
    with_mean,
)
from tallywood.operators.joins import lookup_join, one_row_per_key
from tallywood.operators.ranking import first_row

MEAN, N = "avg_rating", "n_ratings"

# The least number of ratings for a ranked item, and the labels of items and
# occupations that a lookup does not find.
MIN_RATINGS = 5
UNKNOWN_ITEM = ("Unknown(", ")")
UNTITLED = "Unknown Title"
UNKNOWN_OCCUPATION = "OccupationID_"


def mean_by_item(
    ratings: DataFrame, items: DataFrame, min_ratings: int = MIN_RATINGS
) -> DataFrame:
    """``title, avg_rating, n_ratings`` of items with enough ratings, best first.

    The mean is rounded to two digits before sorting. An item without a title gets a label
    made from its id; a title that occurs twice for an item does not repeat it.
    """
    rated = totals(ratings, "item_id").where(F.col(COUNT) >= min_ratings)
    titles = one_row_per_key(items, "item_id", "title")
    labelled = rated.join(titles, "item_id", "left").withColumn(
        "title", label_or(F.col("title"), UNKNOWN_ITEM[0], F.col("item_id"), UNKNOWN_ITEM[1])
    )
    means = with_mean(labelled, MEAN, N).withColumn(MEAN, round_half_even(F.col(MEAN)))
    return means.select("title", MEAN, N).orderBy(F.desc(MEAN), F.desc(N), "title")


def best_item(ratings: DataFrame, items: DataFrame, min_ratings: int = MIN_RATINGS) -> DataFrame:
    """The item with the highest mean, then the most ratings, then the first title."""
    order = [F.desc(MEAN), F.desc(N), F.col("title")]
    return first_row(mean_by_item(ratings, items, min_ratings), order)


def mean_of_every_item(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """``item_id, title, avg_rating, n_ratings`` of every rated item, the mean unrounded.

    Items come in the byte order of their id as text, and share one label where untitled.
    """
    titles = one_row_per_key(items, "item_id", "title")
    means = with_mean(totals(ratings, "item_id"), MEAN, N).join(titles, "item_id", "left")
    title = F.coalesce(F.col("title"), F.lit(UNTITLED)).alias("title")
    return means.select("item_id", title, MEAN, N).orderBy(F.col("item_id").cast("string"))


def best_of_every_item(means: DataFrame, min_ratings: int = MIN_RATINGS) -> DataFrame:
    """The highest unrounded mean among items with enough ratings; ties go to the first id."""
    enough = means.where(F.col(N) >= min_ratings)
    return first_row(enough, [F.desc(MEAN), F.col("item_id").cast("string")])


def mean_by_genre(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """``genre, avg_rating, n_ratings``; an item counts in each of its genres."""
    per_item = totals(ratings, "item_id").join(items.select("item_id", "genres"), "item_id")
    per_genre = combined(per_item.withColumn("genre", F.explode("genres")), "genre")
    return with_mean(per_genre, MEAN, N).orderBy(F.desc(MEAN), F.desc(N), "genre")


def _with_user(ratings: DataFrame, users: DataFrame, attribute: str) -> DataFrame:
    """``item_id, score`` and one attribute of the user who rated."""
    rated = ratings.select("user_id", "item_id", "score")
    return lookup_join(rated, users.select("user_id", attribute), "user_id")


def mean_by_item_gender(ratings: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """``item_id, title, gender, avg_rating, n_ratings``, one row per item and gender."""
    rated = _with_user(ratings, users, "gender")
    means = mean_and_count(rated, "item_id", "gender", value="score", mean=MEAN, n=N)
    named = means.join(items.select("item_id", "title"), "item_id")
    return named.select("item_id", "title", "gender", MEAN, N).orderBy("item_id", "gender")


def _by_title(ratings, users, items, attribute, conditions) -> DataFrame:
    """Cell totals per title: first per item, then over the items that share a title."""
    rated = _with_user(ratings, users, attribute)
    per_item = rated.groupBy("item_id").agg(*cell_totals(conditions))
    titled = per_item.join(items.select("item_id", "title"), "item_id")
    return titled.groupBy("title").agg(*combined_cells(list(conditions)))


def gender_side_by_side(ratings: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """``title, male, female``: two means per title, null where a gender has not rated it.

    Upper and lower case are the same; titles rated by neither still get a row.
    """
    conditions = {g: same_letter(F.col("gender"), g[0]) for g in ("male", "female")}
    cells = _by_title(ratings, users, items, "gender", conditions)
    return cells.select("title", *[cell_mean(g).alias(g) for g in conditions]).orderBy("title")


def age_bands_side_by_side(ratings: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """``title`` and one mean per age band of four, null where a band has not rated it."""
    conditions = band_conditions(F.col("age"), FOUR_BANDS)
    cells = _by_title(ratings, users, items, "age", conditions)
    means = [cell_mean(label).alias(label) for label in conditions]
    return cells.select("title", *means).orderBy("title")


def mean_by_item_band(ratings: DataFrame, users: DataFrame) -> DataFrame:
    """``item_id, band, avg_rating, n_ratings``, one row per item and age band of seven."""
    rated = _with_user(ratings, users, "age")
    banded = rated.select("item_id", band_of(F.col("age"), SEVEN_BANDS).alias("band"), "score")
    means = mean_and_count(banded, "item_id", "band", value="score", mean=MEAN, n=N)
    return means.orderBy("item_id", "band")


def band_map(means: DataFrame) -> DataFrame:
    """``item_id, bands``: the rows of ``mean_by_item_band`` as one map per item.

    A map has one entry per band, seven at most; ratings of users without an age are left out,
    and an item with no others has an empty map.
    """
    entry = F.when(F.col("band").isNotNull(), F.struct("band", F.struct(MEAN, N)))
    return means.groupBy("item_id").agg(F.map_from_entries(F.collect_list(entry)).alias("bands"))


def age_band_table(ratings: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """One row per item: mean and count (``<band> avg``, ``<band> n``) for each band of seven."""
    conditions = band_conditions(F.col("age"), SEVEN_BANDS)
    rated = _with_user(ratings, users, "age")
    cells = rated.groupBy("item_id").agg(*cell_totals(conditions))
    named = cells.join(items.select("item_id", "title"), "item_id")
    columns = []
    for label in conditions:
        columns.append(cell_mean(label).alias(f"{label} avg"))
        columns.append(F.col(f"{label}{COUNT}").alias(f"{label} n"))
    return named.select("item_id", "title", *columns).orderBy("item_id")


def mean_by_occupation(ratings: DataFrame, users: DataFrame, codes: DataFrame) -> DataFrame:
    """``occupation, avg_rating, n_ratings``; a code without a name gets a label of its own."""
    per_user = totals(ratings, "user_id").join(users.select("user_id", "occupation_id"), "user_id")
    per_code = combined(per_user, "occupation_id")
    names = one_row_per_key(codes, "code", "name").withColumnRenamed("code", "occupation_id")
    labelled = per_code.join(names, "occupation_id", "left").withColumn(
        "occupation", label_or(F.col("name"), UNKNOWN_OCCUPATION, F.col("occupation_id"))
    )
    means = with_mean(combined(labelled, "occupation"), MEAN, N)
    return means.orderBy(F.desc(MEAN), F.desc(N), "occupation")


def mean_by_year(ratings: DataFrame) -> DataFrame:
    """``year, avg_rating, n_ratings``; ratings without a valid year are left out."""
    dated = ratings.select(epoch_year(F.col("ts")).alias("year"), "score").where(
        F.col("year").isNotNull()
    )
    return mean_and_count(dated, "year", value="score", mean=MEAN, n=N).orderBy("year")
