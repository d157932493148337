"""Order analyses on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywood.operators import quality
from tallywood.plans import orders as plans
from tallywood.session import fresh_dir
from tallywood.sources.orders import schema_report
from workload import views
from workload.sql import half_up

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
REVENUE_YEAR = 1998
LOW, HIGH = 1, 50

REVENUE_SQL = "(CAST(l_extendedprice AS DECIMAL(18,4)) + CAST(l_tax * 100 AS DECIMAL(18,4)))"
DAYS_SQL = """(SELECT date_diff('day', CAST(l.l_shipdate AS DATE), CAST(o.o_orderdate AS DATE) + 60) AS days
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE o.o_orderstatus <> 'P')"""
SCORES_SQL = """(SELECT event_id, CASE WHEN regexp_matches(s, '^[+-]?[0-9]+$') THEN CAST(s AS INTEGER) END AS score
  FROM (SELECT event_id, trim(CASE event_type WHEN 'error' THEN k || ' pts' WHEN 'signup' THEN ' ' || k || ' ' ELSE k END) AS s
        FROM (SELECT event_id, event_type, json_extract_string(props, '$.k') AS k FROM events)))"""
SELLERS_SQL = f"""(SELECT l_suppkey AS seller_id, CAST(round(sum({REVENUE_SQL}), 2) AS DOUBLE) AS revenue,
  count(DISTINCT l_orderkey) AS n_orders FROM lineitem GROUP BY l_suppkey)"""
RANKED_SQL = f"""SELECT *, dense_rank() OVER (ORDER BY revenue DESC) AS revenue_rank,
  dense_rank() OVER (ORDER BY n_orders DESC) AS orders_rank FROM {SELLERS_SQL}"""


def table_schemas(spark, d):
    report = schema_report(spark, {name: views.table(spark, d, name) for name in TABLES})
    return report.select("table", "ordinal", "column", "type")


def distinct_totals(spark, d):
    return plans.distinct_totals(
        views.orders(spark, d), views.customers(spark, d), views.order_items(spark, d)
    )


def by_country(spark, d):
    """Orders per nation key; the 25 names are attached to the 25 counts."""
    counts = plans.orders_by_country(views.orders(spark, d), views.customers(spark, d))
    names = views.table(spark, d, "nation").select(
        F.col("n_nationkey").alias("customer_country"), F.col("n_name").alias("country")
    )
    return counts.join(names, "customer_country").select("country", "n_orders").orderBy(
        F.desc("n_orders"), "country"
    )


def by_month(spark, d):
    return plans.orders_by_month(views.orders(spark, d))


def score_split(spark, d):
    return plans.score_quality(views.scored_events(spark, d), LOW, HIGH).drop("mean_valid")


def score_mean(spark, d):
    return plans.score_quality(views.scored_events(spark, d), LOW, HIGH).select("mean_valid")


def score_outliers(spark, d):
    scores = quality.with_int_score(views.scored_events(spark, d))
    return quality.outlier_rows(scores, "review_score", LOW, HIGH)


def score_missing(spark, d):
    scores = quality.with_int_score(views.scored_events(spark, d))
    return quality.missing_rows(scores, "review_score").select("event_id")


def score_histogram(spark, d):
    return plans.score_histogram(views.scored_events(spark, d), LOW, HIGH)


def revenue(spark, d):
    return plans.revenue_by_category(
        views.orders(spark, d), views.order_items(spark, d), views.products(spark, d), REVENUE_YEAR
    )


def delivery_totals(spark, d):
    return plans.delivery_totals(views.orders(spark, d), views.order_items(spark, d))


def delivery_status(spark, d):
    return plans.delivery_by_status(views.orders(spark, d), views.order_items(spark, d))


def by_month_merged(spark, d):
    """Months from the stored days of two batches that share a third of the orders."""
    path, rows = fresh_dir(spark, "days"), views.orders(spark, d)
    for left_out in (0, 1):
        batch = rows.where(F.pmod(F.col("order_id"), F.lit(3)) != left_out)
        plans.daily_order_parts(batch).write.mode("append").parquet(path)
    return plans.by_month_of_parts(spark.read.parquet(path))


def seller_ranking(spark, d):
    return plans.seller_ranking(views.order_items(spark, d))


def top_sellers(spark, d):
    return plans.top_sellers(views.order_items(spark, d))


QUERIES = {
    "table_schemas": (
        table_schemas,
        """SELECT table_name AS "table", CAST(ordinal_position AS INTEGER) AS ordinal, column_name AS "column",
  CASE data_type WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string'
    WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>'
    ELSE data_type END AS type
FROM information_schema.columns WHERE table_name IN (""" + ", ".join(f"'{t}'" for t in TABLES) + ")"),
    "distinct_totals": (
        distinct_totals,
        """SELECT 'orders' AS what, count(*) AS total FROM (SELECT DISTINCT o_orderkey FROM orders)
UNION ALL SELECT 'customers', count(*) FROM (SELECT DISTINCT c_name FROM customer)
UNION ALL SELECT 'sellers', count(*) FROM (SELECT DISTINCT l_suppkey FROM lineitem)"""),
    "orders_by_country": (
        by_country,
        """SELECT n.n_name AS country, count(DISTINCT o.o_orderkey) AS n_orders
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
GROUP BY n.n_name"""),
    "orders_by_year_month": (
        by_month,
        """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  count(DISTINCT o_orderkey) AS n_orders FROM orders GROUP BY 1, 2"""),
    "orders_by_month_merged": (
        by_month_merged,
        """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  count(DISTINCT o_orderkey) AS n_orders FROM orders GROUP BY 1, 2"""),
    "score_quality_split": (
        score_split,
        f"""SELECT count(*) AS total, count(*) FILTER (score IS NULL) AS missing,
  count(*) FILTER (score IS NOT NULL AND score NOT BETWEEN {LOW} AND {HIGH}) AS outliers,
  count(*) FILTER (score BETWEEN {LOW} AND {HIGH}) AS valid FROM {SCORES_SQL}"""),
    "score_mean_valid": (
        score_mean,
        f"SELECT {half_up('sum(score) / count(*)')} AS mean_valid FROM {SCORES_SQL} WHERE score BETWEEN {LOW} AND {HIGH}"),
    "score_outlier_rows": (
        score_outliers,
        f"SELECT event_id, score AS review_score FROM {SCORES_SQL} WHERE score < {LOW} OR score > {HIGH}"),
    "score_missing_rows": (score_missing, f"SELECT event_id FROM {SCORES_SQL} WHERE score IS NULL"),
    "score_histogram": (
        score_histogram,
        f"SELECT score AS review_score, count(*) AS n FROM {SCORES_SQL} WHERE score BETWEEN {LOW} AND {HIGH} GROUP BY score"),
    "revenue_by_category_year": (
        revenue,
        f"""SELECT p_type AS product_category_name, CAST(round(sum({REVENUE_SQL}), 2) AS DOUBLE) AS revenue
FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
WHERE year(o_orderdate) = {REVENUE_YEAR} GROUP BY p_type"""),
    "delivery_totals": (
        delivery_totals,
        f"""SELECT count(*) AS total, count(*) FILTER (days < 0) AS early, count(*) FILTER (days = 0) AS on_time,
  count(*) FILTER (days > 0) AS late, {half_up('sum(days) / count(days)')} AS mean_days FROM {DAYS_SQL}"""),
    "delivery_status": (
        delivery_status,
        f"""SELECT status, count(*) AS n, {half_up('sum(days) / count(days)')} AS mean_days
FROM (SELECT days, CASE WHEN days < 0 THEN 'early' WHEN days = 0 THEN 'on time' ELSE 'late' END AS status FROM {DAYS_SQL})
GROUP BY status"""),
    "seller_ranking": (seller_ranking, RANKED_SQL),
    "seller_ranking_top50": (top_sellers, f"{RANKED_SQL} ORDER BY revenue DESC, seller_id LIMIT 50"),
}
