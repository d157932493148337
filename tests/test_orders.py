import datetime as dt

from conftest import rows

from pyspark.sql import functions as F

from tallywood.plans import orders as plans

DAY = dt.datetime(2024, 5, 10, 12)


def orders_of(spark, data):
    return spark.createDataFrame(data, "Order_ID string, Customer_Trx_ID string, Order_Purchase_Timestamp timestamp, "
                                       "Order_Delivered_Carrier_Date timestamp")


def items_of(spark, data):
    return spark.createDataFrame(data, "Order_ID string, Product_ID string, Seller_ID string, Shipping_Limit_Date timestamp, "
                                       "Price double, Freight_Value double")


def test_distinct_totals_count_null_once(spark):
    orders = orders_of(spark, [("a", "x", None, None), ("a", "x", None, None), (None, "y", None, None), (None, "y", None, None)])
    customers = spark.createDataFrame([("s",), ("t",)], "Subscriber_ID string")
    items = items_of(spark, [("a", "p", "v", None, 1.0, 1.0)] * 3)
    assert rows(plans.distinct_totals(orders, customers, items)) == [("orders", 2), ("customers", 2), ("sellers", 1)]


def test_orders_by_country_counts_an_order_once_per_country(spark):
    orders = orders_of(spark, [("a", "x", None, None), ("a", "y", None, None), ("b", "z", None, None), ("c", "w", None, None), (None, "x", None, None)])
    customers = spark.createDataFrame([("x", "FR"), ("y", "FR"), ("z", "DE")], "Customer_Trx_ID string, Customer_Country string")
    assert rows(plans.orders_by_country(orders, customers)) == [("DE", 1), ("FR", 1)]


def test_months_ascend_and_a_missing_time_is_a_group(spark):
    orders = orders_of(spark, [("a", "x", dt.datetime(2024, 2, 1), None), ("b", "x", dt.datetime(2023, 11, 1), None),
                               ("c", "x", dt.datetime(2024, 1, 1), None), ("d", "x", None, None)])
    assert rows(plans.orders_by_month(orders)) == [(None, None, 1), (2023, 11, 1), (2024, 1, 1), (2024, 2, 1)]


def test_score_quality(spark):
    reviews = spark.createDataFrame([(s,) for s in ["5", " 4 ", "x", "0", "6", None, "4.0", "1", "5"]], "Review_Score string")
    split = plans.score_quality(reviews).first()
    assert tuple(split) == (9, 3, 2, 4, 3.75)
    histogram = rows(plans.score_histogram(reviews))
    assert histogram == [(1, 1), (4, 1), (5, 2)]
    assert sum(n for _, n in histogram) == split["valid"] == split["total"] - split["missing"] - split["outliers"]


def test_revenue_of_one_year(spark):
    orders = orders_of(spark, [("a", "x", dt.datetime(2024, 1, 1), None), ("b", "x", dt.datetime(2024, 12, 31, 23, 59, 59), None),
                               ("c", "x", dt.datetime(2025, 1, 1), None), ("d", "x", None, None)])
    items = items_of(spark, [("a", "p", "s", None, 0.1, 0.2), ("a", "q", "s", None, 10.0, 1.0), ("b", "p", "s", None, 1.0, 0.0),
                             ("c", "p", "s", None, 99.0, 0.0), ("d", "p", "s", None, 99.0, 0.0), ("e", "p", "s", None, 99.0, 0.0)])
    products = spark.createDataFrame([("p", "toys"), ("q", None)], "Product_ID string, Product_Category_Name string")
    assert rows(plans.revenue_by_category(orders, items, products, 2024)) == [(None, 11.0), ("toys", 1.3)]


def test_unknown_days_are_late_in_one_view_only(spark):
    orders = orders_of(spark, [("a", "x", None, DAY), ("b", "x", None, None)])
    limits = [DAY + dt.timedelta(days=2), DAY.replace(hour=1), DAY - dt.timedelta(days=3), None]
    items = items_of(spark, [("a", "p", "s", limit, 1.0, 1.0) for limit in limits] + [("b", "p", "s", DAY, 1.0, 1.0)])
    assert rows(plans.delivery_totals(orders, items)) == [(4, 1, 1, 1, 0.33)]
    assert rows(plans.delivery_by_status(orders, items)) == [("early", 1, -2.0), ("late", 2, 3.0), ("on time", 1, 0.0)]


def test_seller_ranks_are_dense(spark):
    items = items_of(spark, [("a", "p", "s1", None, 5.0, 0.0), ("b", "p", "s1", None, 5.0, 0.0), ("a", "p", "s2", None, 10.0, 0.0),
                             ("c", "p", "s3", None, 4.0, 0.5), ("c", "p", "s3", None, 0.0, 0.5)])
    assert rows(plans.seller_ranking(items)) == [
        ("s1", 10.0, 2, 1, 1), ("s2", 10.0, 1, 1, 2), ("s3", 5.0, 1, 2, 2)]
    assert rows(plans.top_sellers(items, 1)) == [("s1", 10.0, 2, 1, 1)]


def test_totals_agree_on_the_test_tables(spark):
    """Orders per country and per month add up to the distinct orders."""
    from workload import orders as queries
    d = "/root/testdata/sf0.001"
    total = {r["what"]: r["total"] for r in queries.distinct_totals(spark, d).collect()}["orders"]
    for query in (queries.by_country, queries.by_month):
        assert query(spark, d).agg(F.sum("n_orders")).first()[0] == total


def test_delivery_views_agree_on_the_test_tables(spark):
    from workload import orders as queries
    d = "/root/testdata/sf0.001"
    totals = queries.delivery_totals(spark, d).first()
    by_status = {r["status"]: r["n"] for r in queries.delivery_status(spark, d).collect()}
    assert by_status == {"early": totals["early"], "on time": totals["on_time"], "late": totals["late"]}
    assert sum(by_status.values()) == totals["total"]
