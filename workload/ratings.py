"""Rating analyses on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywood.operators.aggregates import mean_and_count
from tallywood.functions.numbers import exact
from tallywood.plans import ratings as plans
from tallywood.plans import reports
from workload import views
from workload.sql import half_even, half_up_text

RATINGS_SQL = """(SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, l.l_quantity AS score
 FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""
USERS_SQL = """(SELECT c_custkey AS user_id, lower(substr(c_mktsegment, 1, 1)) AS gender,
 c_nationkey * 3 AS age, c_nationkey AS occupation_id FROM customer)"""

BY_ITEM_SQL = f"""SELECT p.p_name AS title, {half_even('a.s / a.n')} AS avg_rating, a.n AS n_ratings
FROM (SELECT l_partkey, sum(l_quantity) AS s, count(*) AS n FROM lineitem
      GROUP BY l_partkey HAVING count(*) >= 5) a
JOIN part p ON p.p_partkey = a.l_partkey"""

BY_GENRE_SQL = """SELECT genre, sum(l_quantity) / count(*) AS avg_rating, count(*) AS n_ratings
FROM (SELECT l_partkey, l_quantity FROM lineitem) l
JOIN (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS genre FROM part) g
  ON g.p_partkey = l.l_partkey
WHERE genre <> '' GROUP BY genre"""

BY_GENDER_SQL = f"""SELECT r.item_id, p.p_name AS title, u.gender,
  sum(r.score) / count(*) AS avg_rating, count(*) AS n_ratings
FROM {RATINGS_SQL} r JOIN {USERS_SQL} u USING (user_id) JOIN part p ON p.p_partkey = r.item_id
GROUP BY r.item_id, p.p_name, u.gender"""

SIDE_SQL = f"""SELECT p.p_name AS title,
  sum(score) FILTER (gender = 'm') / nullif(count(*) FILTER (gender = 'm'), 0) AS male,
  sum(score) FILTER (gender = 'f') / nullif(count(*) FILTER (gender = 'f'), 0) AS female
FROM {RATINGS_SQL} r JOIN {USERS_SQL} u USING (user_id) JOIN part p ON p.p_partkey = r.item_id
GROUP BY p.p_name"""

FOUR = {"0-18": "age <= 18", "18-35": "age > 18 AND age <= 35", "35-50": "age > 35 AND age <= 50", "50+": "age > 50"}
SEVEN = {
    "<18": "age < 18", "18-24": "age BETWEEN 18 AND 24", "25-34": "age BETWEEN 25 AND 34",
    "35-44": "age BETWEEN 35 AND 44", "45-49": "age BETWEEN 45 AND 49",
    "50-55": "age BETWEEN 50 AND 55", "56+": "age > 55",
}
FOUR_SQL = "SELECT p.p_name AS title, " + ", ".join(
    f'sum(score) FILTER ({c}) / nullif(count(*) FILTER ({c}), 0) AS "{b}"' for b, c in FOUR.items()
) + f""" FROM {RATINGS_SQL} r JOIN {USERS_SQL} u USING (user_id)
JOIN part p ON p.p_partkey = r.item_id GROUP BY p.p_name"""
SEVEN_SQL = "SELECT r.item_id, p.p_name AS title, " + ", ".join(
    f'sum(score) FILTER ({c}) / nullif(count(*) FILTER ({c}), 0) AS "{b} avg", count(*) FILTER ({c}) AS "{b} n"'
    for b, c in SEVEN.items()
) + f""" FROM {RATINGS_SQL} r JOIN {USERS_SQL} u USING (user_id)
JOIN part p ON p.p_partkey = r.item_id GROUP BY r.item_id, p.p_name"""

BY_BAND_SQL = "SELECT item_id, CASE " + " ".join(f"WHEN {c} THEN '{b}'" for b, c in SEVEN.items()) + f""" END AS band,
  sum(score) / count(*) AS avg_rating, count(*) AS n_ratings
FROM {RATINGS_SQL} r JOIN {USERS_SQL} u USING (user_id) GROUP BY 1, 2"""

BY_OCCUPATION_SQL = f"""SELECT occupation, sum(score) / count(*) AS avg_rating, count(*) AS n_ratings
FROM (SELECT coalesce(g.r_name, 'OccupationID_' || CAST(u.occupation_id AS VARCHAR)) AS occupation, r.score
      FROM {RATINGS_SQL} r JOIN {USERS_SQL} u USING (user_id)
      LEFT JOIN region g ON g.r_regionkey = u.occupation_id)
GROUP BY occupation"""

BY_YEAR_SQL = f"""SELECT CAST(year(make_timestamp((CAST(epoch(l_shipdate) AS BIGINT) + {views.TEN_YEARS}) * 1000000)) AS INTEGER) AS year,
  sum(l_quantity) / count(*) AS avg_rating, count(*) AS n_ratings
FROM lineitem GROUP BY 1"""

UNKNOWN_SQL = f"""SELECT coalesce(s.s_name, 'Unknown(' || CAST(a.o_custkey AS VARCHAR) || ')') AS title,
  {half_even('CAST(a.s AS DOUBLE) / a.n')} AS avg_rating, a.n AS n_ratings
FROM (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s, count(*) AS n
      FROM orders GROUP BY o_custkey HAVING count(*) >= 5) a
LEFT JOIN supplier s ON s.s_suppkey = a.o_custkey"""

EVERY_ITEM_SQL = """SELECT o.o_custkey AS item_id, coalesce(max(s.s_name), 'Unknown Title') AS title,
  CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_rating, count(*) AS n_ratings
FROM orders o LEFT JOIN supplier s ON s.s_suppkey = o.o_custkey GROUP BY o.o_custkey"""


def by_item(spark, d):
    return plans.mean_by_item(views.item_ratings(spark, d), views.items(spark, d))


def best_item(spark, d):
    return plans.best_item(views.item_ratings(spark, d), views.items(spark, d))


def _customer_ratings(spark, d):
    """Orders rate their customer; only some customer numbers are supplier numbers too."""
    rated = views.table(spark, d, "orders").select(
        F.col("o_custkey").alias("item_id"), exact(F.col("o_totalprice")).alias("score")
    )
    named = views.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("item_id"), F.col("s_name").alias("title")
    )
    return rated, named


def unknown_items(spark, d):
    return plans.mean_by_item(*_customer_ratings(spark, d))


def by_genre(spark, d):
    return plans.mean_by_genre(views.item_ratings(spark, d), views.items(spark, d))


def _all(spark, d):
    return views.ratings(spark, d), views.users(spark, d), views.items(spark, d)


def by_item_gender(spark, d):
    return plans.mean_by_item_gender(*_all(spark, d))


def side_by_side(spark, d):
    return plans.gender_side_by_side(*_all(spark, d))


def four_bands(spark, d):
    return plans.age_bands_side_by_side(*_all(spark, d))


def seven_bands(spark, d):
    return plans.age_band_table(*_all(spark, d))


def by_item_band(spark, d):
    return plans.mean_by_item_band(views.ratings(spark, d), views.users(spark, d))


def looked_up_bands(spark, d):
    """Two bands looked up in the map of an item; a band that is not there gives null."""
    found = plans.band_map(by_item_band(spark, d))
    young, old = (F.try_element_at("bands", F.lit(b)) for b in ("<18", "56+"))
    return found.select(
        "item_id", F.size("bands").cast("bigint").alias("n_bands"),
        young["avg_rating"].alias("young_avg"), old["n_ratings"].alias("old_n"),
    )


def item_report_text(spark, d):
    """The item report with its heading and the best item below."""
    found = by_item(spark, d)
    best = reports.best_item_lines(plans.first_row(found, [F.desc("avg_rating"), F.desc("n_ratings"), F.col("title")]))
    return reports.item_report(found, best)


def by_occupation(spark, d):
    return plans.mean_by_occupation(views.ratings(spark, d), views.users(spark, d), views.codes(spark, d))


def by_year(spark, d):
    return plans.mean_by_year(views.item_ratings(spark, d))


def union_of_inputs(spark, d):
    rated = views.item_ratings(spark, d).select("item_id", "score", "l_linestatus")
    first, second = (rated.where(F.col("l_linestatus") == x).drop("l_linestatus") for x in "OF")
    return mean_and_count(first.unionByName(second), "item_id", value="score", mean="avg_rating", n="n_ratings")


def item_report(spark, d):
    return reports.item_lines(by_item(spark, d))


def genre_report(spark, d):
    return reports.group_lines(by_genre(spark, d), "genre", (25, 12, 10))


def gender_report(spark, d):
    return reports.item_gender_lines(by_item_gender(spark, d))


def band_report(spark, d):
    return reports.band_lines(seven_bands(spark, d))


def genre_report_text(spark, d):
    return reports.group_report(by_genre(spark, d), "genre", (25, 12, 10), ("Genre", "Average", "Ratings"))


def occupation_report_text(spark, d):
    means = by_occupation(spark, d)
    return reports.group_report(means, "occupation", (35, 12, 10), ("Occupation", "Average", "Ratings"))


def year_report_text(spark, d):
    return reports.group_report(by_year(spark, d), "year", (10, 12, 10), ("Year", "Average", "Ratings"))


def gender_report_text(spark, d):
    return reports.item_gender_report(by_item_gender(spark, d))


def band_report_text(spark, d):
    return reports.band_report(seven_bands(spark, d))


def every_item(spark, d):
    """Orders rate their customer, as in ``unknown_items``, with one fixed label instead."""
    return plans.mean_of_every_item(*_customer_ratings(spark, d))


def item_sentences(spark, d):
    return reports.item_key_values(every_item(spark, d))


def best_sentence(spark, d):
    return reports.best_item_key_value(plans.best_of_every_item(every_item(spark, d)))


def genre_sentences(spark, d):
    return reports.genre_key_values(by_genre(spark, d))


def gender_sentences(spark, d):
    return reports.gender_key_values(side_by_side(spark, d))


def band_sentences(spark, d):
    return reports.age_band_key_values(four_bands(spark, d))


def _padded(value: str, width: int) -> str:
    return f"lpad(CAST({value} AS VARCHAR), {width}, ' ')"


def _two(value: str, width: int) -> str:
    return f"lpad(printf('%.2f', {value}), {width}, ' ')"


def _band_cell(band: str) -> str:
    """Padded to 21 characters; a longer cell keeps its length."""
    votes = f"""printf('%.2f', "{band} avg") || ' (' || CAST("{band} n" AS VARCHAR) || ' votes)'"""
    cell = f"""('{band}: ' || CASE WHEN "{band} n" > 0 THEN {votes} ELSE 'N/A' END)"""
    return f"rpad({cell}, CAST(greatest(21, length({cell})) AS INTEGER), ' ')"


_band_cells = " || ' | ' || ".join(_band_cell(b) for b in SEVEN)
_four_cells = " || ' ' || ".join(
    f"""'{b}: ' || coalesce({half_up_text(f'"{b}"')}, 'NA')""" for b in FOUR
)

GENRE_LINES_SQL = (
    f"SELECT rpad(genre, 25, ' ') || ' ' || {_two('avg_rating', 12)} || ' ' || {_padded('n_ratings', 10)} AS line FROM ({BY_GENRE_SQL})")
GENDER_LINES_SQL = (
    f"SELECT rpad(CAST(item_id AS VARCHAR), 10, ' ') || ' ' || rpad(title, 60, ' ') || ' ' || rpad(gender, 8, ' ') "
    f"|| ' ' || {_two('avg_rating', 10)} || ' ' || {_padded('n_ratings', 8)} AS line FROM ({BY_GENDER_SQL})")
BAND_LINES_SQL = (
    f"SELECT 'ID: ' || CASE WHEN item_id < 10000 THEN rpad(CAST(item_id AS VARCHAR), 4, ' ') "
    f"ELSE CAST(item_id AS VARCHAR) END || ' | ' || rpad(substr(title, 1, 35), 35, ' ') || ' | ' || {_band_cells} AS line "
    f"FROM ({SEVEN_SQL})")


def _group_text_sql(sql: str, group: str, width: int, title: str) -> str:
    """Heading and lines of one group; names longer than their column keep their length."""
    padded = f"CASE WHEN length(g) < {width} THEN rpad(g, {width}, ' ') ELSE g END"
    lines = (f"SELECT {padded} || ' ' || {_two('avg_rating', 12)} || ' ' || {_padded('n_ratings', 10)} AS line "
             f"FROM (SELECT CAST({group} AS VARCHAR) AS g, avg_rating, n_ratings FROM ({sql}))")
    rule = f"repeat('=', {width + 24})"
    return f"{lines} UNION ALL SELECT unnest([{rule}, rpad('{title}', {width}, ' ') || '      Average    Ratings', {rule}])"


QUERIES = {
    "rating_mean_by_item": (by_item, BY_ITEM_SQL),
    "rating_mean_unknown_items": (unknown_items, UNKNOWN_SQL),
    "best_item_min_support": (
        best_item, f"SELECT * FROM ({BY_ITEM_SQL}) ORDER BY avg_rating DESC, n_ratings DESC, title LIMIT 1"),
    "rating_mean_by_genre": (by_genre, BY_GENRE_SQL),
    "rating_mean_by_item_segment": (by_item_gender, BY_GENDER_SQL),
    "rating_segment_side_by_side": (side_by_side, SIDE_SQL),
    "rating_band_pivot4": (four_bands, FOUR_SQL),
    "rating_band_pivot7": (seven_bands, SEVEN_SQL),
    "rating_mean_by_item_band": (by_item_band, BY_BAND_SQL),
    "rating_band_map": (
        looked_up_bands,
        f"""SELECT item_id, count(*) AS n_bands, max(avg_rating) FILTER (band = '<18') AS young_avg,
  max(n_ratings) FILTER (band = '56+') AS old_n FROM ({BY_BAND_SQL}) GROUP BY item_id"""),
    "rating_mean_by_code_label": (by_occupation, BY_OCCUPATION_SQL),
    "rating_mean_by_year": (by_year, BY_YEAR_SQL),
    "rating_union_files": (
        union_of_inputs,
        "SELECT l_partkey AS item_id, sum(l_quantity) / count(*) AS avg_rating, count(*) AS n_ratings "
        "FROM lineitem GROUP BY l_partkey"),
    "report_lines_items": (
        item_report,
        f"SELECT rpad(title, 65, ' ') || ' ' || {_two('avg_rating', 10)} || ' ' || {_padded('n_ratings', 8)} AS line "
        f"FROM ({BY_ITEM_SQL})"),
    "report_text_items": (
        item_report_text,
        f"""WITH m AS ({BY_ITEM_SQL}), b AS (SELECT * FROM m ORDER BY avg_rating DESC, n_ratings DESC, title LIMIT 1)
SELECT rpad(title, 65, ' ') || ' ' || {_two('avg_rating', 10)} || ' ' || {_padded('n_ratings', 8)} AS line FROM m
UNION ALL SELECT unnest([repeat('=', 85), rpad('Title', 65, ' ') || ' Avg Rating  Ratings', repeat('=', 85)])
UNION ALL SELECT unnest(['', repeat('=', 85), 'Best item with at least 5 ratings:', 'Title: ' || title,
  'Average: ' || printf('%.2f', avg_rating), 'Ratings: ' || CAST(n_ratings AS VARCHAR), repeat('=', 85)]) FROM b"""),
    "report_lines_genres": (genre_report, GENRE_LINES_SQL),
    "report_lines_item_segment": (gender_report, GENDER_LINES_SQL),
    "report_lines_bands": (band_report, BAND_LINES_SQL),
    "report_text_genres": (genre_report_text, _group_text_sql(BY_GENRE_SQL, "genre", 25, "Genre")),
    "report_text_occupations": (occupation_report_text, _group_text_sql(BY_OCCUPATION_SQL, "occupation", 35, "Occupation")),
    "report_text_years": (year_report_text, _group_text_sql(BY_YEAR_SQL, "year", 10, "Year")),
    "report_text_item_segment": (
        gender_report_text,
        f"{GENDER_LINES_SQL} UNION ALL SELECT unnest([repeat('=', 100), rpad('Item', 10, ' ') || ' ' || rpad('Title', 60, ' ') "
        "|| ' ' || rpad('Gender', 8, ' ') || '    Average  Ratings', repeat('=', 100)])"),
    "report_text_bands": (
        band_report_text,
        f"{BAND_LINES_SQL} UNION ALL SELECT unnest([repeat('=', 80), 'Ratings by age band', repeat('=', 80), repeat('=', 80)]) "
        f"UNION ALL SELECT 'Items: ' || CAST(count(*) AS VARCHAR) FROM ({SEVEN_SQL})"),
    "rating_mean_every_item": (every_item, EVERY_ITEM_SQL),
    "key_value_items": (
        item_sentences,
        f"SELECT title AS key, 'Average rating: ' || {half_up_text('avg_rating')} || ' (Total ratings: ' "
        f"|| CAST(n_ratings AS VARCHAR) || ')' AS value FROM ({EVERY_ITEM_SQL})"),
    "key_value_best_item": (
        best_sentence,
        f"SELECT title AS key, 'is the highest rated movie with an average rating of ' || {half_up_text('avg_rating')} "
        f"|| ' among movies with at least 5 ratings.' AS value FROM ({EVERY_ITEM_SQL}) WHERE n_ratings >= 5 "
        "ORDER BY avg_rating DESC, CAST(item_id AS VARCHAR) LIMIT 1"),
    "key_value_genres": (
        genre_sentences,
        f"SELECT genre AS key, 'Avg: ' || {half_up_text('avg_rating')} || ',  Count: ' "
        f"|| CAST(n_ratings AS VARCHAR) AS value FROM ({BY_GENRE_SQL})"),
    "key_value_segments": (
        gender_sentences,
        f"SELECT title AS key, 'Male: ' || coalesce({half_up_text('male')}, 'N/A') || ', Female: ' "
        f"|| coalesce({half_up_text('female')}, 'N/A') AS value FROM ({SIDE_SQL})"),
    "key_value_bands": (band_sentences, f"SELECT title AS key, {_four_cells} AS value FROM ({FOUR_SQL})"),
}
