"""Order analyses on order, customer, item, review and product tables.

Column names are those of the input files; Spark ignores their case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallywood.functions.bands import delivery_status
from tallywood.functions.dates import day_difference, in_year
from tallywood.functions.numbers import exact
from tallywood.operators.aggregates import distinct_total
from tallywood.operators.distinct import distinct_counts, distinct_parts
from tallywood.operators.joins import lookup_join
from tallywood.operators.quality import histogram, quality_split, valid_rows, with_int_score
from tallywood.operators.ranking import dense_ranks_of, global_dense_rank
from tallywood.session import materialize

# The range of a valid score and the length of the seller report.
LOWEST_SCORE, HIGHEST_SCORE = 1, 5
TOP_SELLERS = 50


def distinct_totals(orders: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """``what, total``: distinct orders, subscribers and sellers."""
    counted = {
        "orders": distinct_total(orders, "order_id"),
        "customers": distinct_total(customers, "subscriber_id"),
        "sellers": distinct_total(items, "seller_id"),
    }
    rows = [df.select(F.lit(what).alias("what"), "total") for what, df in counted.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def orders_by_country(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """``customer_country, n_orders``: distinct orders per country, most first."""
    joined = lookup_join(
        orders.select("order_id", "customer_trx_id"),
        customers.select("customer_trx_id", "customer_country"),
        "customer_trx_id",
    )
    counts = joined.groupBy("customer_country").agg(F.count_distinct("order_id").alias("n_orders"))
    return counts.orderBy(F.desc("n_orders"), "customer_country")


def orders_by_month(orders: DataFrame) -> DataFrame:
    """``year, month, n_orders`` by purchase time, in order of time."""
    moment = F.col("order_purchase_timestamp")
    months = orders.select(F.year(moment).alias("year"), F.month(moment).alias("month"), "order_id")
    counts = months.groupBy("year", "month").agg(F.count_distinct("order_id").alias("n_orders"))
    return counts.orderBy("year", "month")


def daily_order_parts(orders: DataFrame) -> DataFrame:
    """``day, bucket, bitmap``: the orders of each day, to be kept and merged with later batches."""
    days = orders.select(F.to_date("order_purchase_timestamp").alias("day"), "order_id")
    return distinct_parts(days, ["day"], "order_id")


def by_month_of_parts(parts: DataFrame) -> DataFrame:
    """``year, month, n_orders`` from stored days; an order that several batches bring counts once."""
    months = parts.withColumns({"year": F.year("day"), "month": F.month("day")})
    return distinct_counts(months, ["year", "month"], "n_orders").orderBy("year", F.desc("month"))


def score_quality(
    reviews: DataFrame, low: int = LOWEST_SCORE, high: int = HIGHEST_SCORE
) -> DataFrame:
    """One row: ``total, missing, outliers, valid, mean_valid``."""
    return quality_split(with_int_score(reviews), "review_score", low, high)


def score_histogram(
    reviews: DataFrame, low: int = LOWEST_SCORE, high: int = HIGHEST_SCORE
) -> DataFrame:
    """``review_score, n`` of the valid scores."""
    scores = with_int_score(reviews.select("review_score"))
    return histogram(valid_rows(scores, "review_score", low, high), "review_score")


def item_revenue():
    """Price plus freight, exact to four digits."""
    return exact(F.col("price"), 4) + exact(F.col("freight_value"), 4)


def revenue_by_category(
    orders: DataFrame, items: DataFrame, products: DataFrame, year: int
) -> DataFrame:
    """``product_category_name, revenue`` of the orders of one year, highest first.

    Revenue is summed per product before the product table is joined.
    """
    chosen = orders.where(in_year(F.col("order_purchase_timestamp"), year)).select("order_id")
    priced = items.select("order_id", "product_id", item_revenue().alias("revenue"))
    sold = lookup_join(priced, chosen, "order_id")
    per_product = sold.groupBy("product_id").agg(F.sum("revenue").alias("revenue"))
    named = per_product.join(products.select("product_id", "product_category_name"), "product_id")
    summed = named.groupBy("product_category_name").agg(F.sum("revenue").alias("revenue"))
    rounded = summed.withColumn("revenue", F.round("revenue", 2).cast("double"))
    return rounded.orderBy(F.desc("revenue"), "product_category_name")


def handed_over(orders: DataFrame, items: DataFrame) -> DataFrame:
    """``days`` from shipping limit to hand-over for every item of an order handed over."""
    shipped = orders.where(F.col("order_delivered_carrier_date").isNotNull())
    joined = lookup_join(
        items.select("order_id", "shipping_limit_date"),
        shipped.select("order_id", "order_delivered_carrier_date"),
        "order_id",
    )
    days = day_difference(F.col("order_delivered_carrier_date"), F.col("shipping_limit_date"))
    return joined.select(days.alias("days"))


def delivery_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row: ``total, early, on_time, late, mean_days``; unknown days are in the total only."""
    days = F.col("days")
    return handed_over(orders, items).agg(
        F.count("*").alias("total"),
        F.count_if(days < 0).alias("early"),
        F.count_if(days == 0).alias("on_time"),
        F.count_if(days > 0).alias("late"),
        F.round(F.avg(days), 2).alias("mean_days"),
    )


def delivery_by_status(orders: DataFrame, items: DataFrame) -> DataFrame:
    """``status, n, mean_days``; here unknown days count as late."""
    rows = handed_over(orders, items).withColumn("status", delivery_status(F.col("days")))
    summary = rows.groupBy("status").agg(
        F.count("*").alias("n"), F.round(F.avg("days"), 2).alias("mean_days")
    )
    return summary.orderBy("status")


def seller_totals(items: DataFrame) -> DataFrame:
    """``seller_id, revenue, n_orders``."""
    rows = items.select("seller_id", "order_id", item_revenue().alias("revenue"))
    return rows.groupBy("seller_id").agg(
        F.round(F.sum("revenue"), 2).cast("double").alias("revenue"),
        F.count_distinct("order_id").alias("n_orders"),
    )


def seller_ranking(items: DataFrame) -> DataFrame:
    """All sellers with dense ranks by revenue and by orders, highest revenue first."""
    sellers = materialize(seller_totals(items))
    ranked = global_dense_rank(sellers, "revenue", "revenue_rank")
    ranked = global_dense_rank(ranked, "n_orders", "orders_rank")
    return ranked.orderBy(F.desc("revenue"), "seller_id")


def top_sellers(items: DataFrame, n: int = TOP_SELLERS) -> DataFrame:
    """The first ``n`` rows of ``seller_ranking``, without ranking the others.

    The ``n`` rows come to the driver; their ranks need counts of distinct higher values only.
    """
    sellers = materialize(seller_totals(items))
    first = sellers.orderBy(F.desc("revenue"), "seller_id").limit(n).collect()
    revenue = dense_ranks_of(sellers, "revenue", [r["revenue"] for r in first])
    orders = dense_ranks_of(sellers, "n_orders", [r["n_orders"] for r in first])
    rows = [(*r, revenue[r["revenue"]], orders[r["n_orders"]]) for r in first]
    ranks = StructType([StructField(name, LongType()) for name in ("revenue_rank", "orders_rank")])
    ranked = items.sparkSession.createDataFrame(rows, StructType([*sellers.schema, *ranks]))
    return ranked.orderBy(F.desc("revenue"), "seller_id")
