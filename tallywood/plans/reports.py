"""The analyses as text lines. Labels and formats are fixed values of each report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.functions.bands import FOUR_BANDS, SEVEN_BANDS
from tallywood.functions.numbers import fixed_half_even, fixed_half_up
from tallywood.plans.ratings import MEAN, N
from tallywood.sinks.report import (
    cut,
    heading,
    left,
    report_lines,
    report_text,
    right,
    two_digits,
)

ITEM_RULE = 85
NO_MEAN = "N/A"
NO_BAND_MEAN = "NA"


def or_label(text: Column, label: str) -> Column:
    return F.coalesce(text, F.lit(label))


def item_lines(means: DataFrame) -> DataFrame:
    """Title, mean and count in columns of 65, 10 and 8 characters."""
    cells = [left(F.col("title"), 65), two_digits(F.col(MEAN), 10), right(F.col(N), 8)]
    return report_lines(means, cells)


def best_item_lines(
    best: DataFrame,
    intro: str = "Best item with at least 5 ratings:",
    labels: tuple[str, str, str] = ("Title", "Average", "Ratings"),
) -> DataFrame:
    """The closing lines of the item report."""
    rule = F.lit("=" * ITEM_RULE)
    values = F.col("title"), fixed_half_even(F.col(MEAN)), F.col(N).cast("string")
    stated = [F.concat(F.lit(f"{label}: "), value) for label, value in zip(labels, values)]
    lines = F.array(F.lit(""), rule, F.lit(intro), *stated, rule)
    return best.select(F.explode(lines).alias("line"))


def item_report(
    means: DataFrame,
    closing: DataFrame,
    titles: tuple[str, str, str] = ("Title", "Avg Rating", "Ratings"),
) -> DataFrame:
    """The whole item report: heading, items, best item. Labels are free to choose."""
    head = heading(list(titles), [65, -10, -8], "=", ITEM_RULE)
    return report_text(head, item_lines(means), closing)


def group_lines(means: DataFrame, group: str, widths: tuple[int, int, int]) -> DataFrame:
    """One group per line: genre (25), occupation (35) or year (10), then mean and count."""
    first, second, third = widths
    cells = [left(F.col(group), first), two_digits(F.col(MEAN), second), right(F.col(N), third)]
    return report_lines(means, cells)


def item_gender_lines(means: DataFrame) -> DataFrame:
    cells = [
        left(F.col("item_id"), 10),
        left(F.col("title"), 60),
        left(F.col("gender"), 8),
        two_digits(F.col(MEAN), 10),
        right(F.col(N), 8),
    ]
    return report_lines(means, cells)


def band_lines(table: DataFrame) -> DataFrame:
    """One item per line, the title cut to 35 characters, one cell of 21 per band."""
    cells = [
        F.concat(F.lit("ID: "), left(F.col("item_id"), 4)),
        left(cut(F.col("title"), 35), 35),
    ]
    for label, _ in SEVEN_BANDS:
        mean, n = F.col(f"`{label} avg`"), F.col(f"`{label} n`")
        votes = F.concat(fixed_half_even(mean), F.format_string(" (%d votes)", n))
        cell = F.when(n > 0, votes).otherwise(NO_MEAN)
        cells.append(left(F.concat(F.lit(f"{label}: "), cell), 21))
    return report_lines(table, cells, " | ")


def group_report(
    means: DataFrame, group: str, widths: tuple[int, int, int], titles: tuple[str, str, str]
) -> DataFrame:
    """Heading and lines of the means of genres, occupations or years. Labels are free."""
    length = sum(widths) + 2
    head = heading(list(titles), [widths[0], -widths[1], -widths[2]], "=", length)
    return report_text(head, group_lines(means, group, widths))


def item_gender_report(
    means: DataFrame, titles: tuple[str, ...] = ("Item", "Title", "Gender", "Average", "Ratings")
) -> DataFrame:
    """Heading and lines of the means of items and genders."""
    head = heading(list(titles), [10, 60, 8, -10, -8], "=", 100)
    return report_text(head, item_gender_lines(means))


def band_report(table: DataFrame, title: str = "Ratings by age band") -> DataFrame:
    """Heading, lines and the number of items below."""
    rule = "=" * 80
    total = F.concat(F.lit("Items: "), F.count("*").cast("string"))
    foot = table.agg(total.alias("total")).select(F.explode(F.array(F.lit(rule), "total")).alias("line"))
    return report_text([rule, title, rule], band_lines(table), foot)


def item_key_values(means: DataFrame) -> DataFrame:
    """``key, value``: title and a sentence with mean and count."""
    value = F.format_string("Average rating: %.2f (Total ratings: %d)", F.col(MEAN), F.col(N))
    return means.select(F.col("title").alias("key"), value.alias("value"))


def best_item_key_value(best: DataFrame, min_ratings: int = 5) -> DataFrame:
    value = F.format_string(
        "is the highest rated movie with an average rating of %.2f among movies with "
        f"at least {min_ratings} ratings.",
        F.col(MEAN),
    )
    return best.select(F.col("title").alias("key"), value.alias("value"))


def genre_key_values(means: DataFrame) -> DataFrame:
    value = F.format_string("Avg: %.2f,  Count: %d", F.col(MEAN), F.col(N))
    return means.select(F.col("genre").alias("key"), value.alias("value"))


def gender_key_values(table: DataFrame) -> DataFrame:
    male, female = (or_label(fixed_half_up(F.col(g)), NO_MEAN) for g in ("male", "female"))
    value = F.concat(F.lit("Male: "), male, F.lit(", Female: "), female)
    return table.select(F.col("title").alias("key"), value.alias("value"))


def age_band_key_values(table: DataFrame) -> DataFrame:
    cells = [
        F.concat(F.lit(f"{label}: "), or_label(fixed_half_up(F.col(f"`{label}`")), NO_BAND_MEAN))
        for label, _ in FOUR_BANDS
    ]
    return table.select(F.col("title").alias("key"), F.concat_ws(" ", *cells).alias("value"))
