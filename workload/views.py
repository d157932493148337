"""The test tables in the shape the analyses expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.functions.documents import encode_base64
from tallywood.functions.parsing import split_list
from tallywood.operators.joins import lookup_join
from tallywood.session import apply_settings

TEN_YEARS = 315_532_800
STOP_WORDS = ["the", "and", "of", "in", "is", "that", "with", "for", "by", "on",
              "le", "la", "de", "et", "un", "une", "el", "los", "der", "die", "und"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return apply_settings(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows of a small file, which comes in one piece, dealt out over the tasks of the session."""
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def epoch(moment):
    """Epoch seconds with microseconds."""
    return F.unix_micros(moment.cast("timestamp")) / 1_000_000


# Ratings: an order line is a rating of its part by the customer of its order.


def item_ratings(spark, sf_dir) -> DataFrame:
    seconds = F.unix_timestamp(F.col("l_shipdate").cast("timestamp")) + TEN_YEARS
    stamp = F.when(F.col("l_linestatus") == "F", seconds * 1000).otherwise(seconds)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey"), F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("score"), stamp.alias("ts"), "l_linestatus",
    )


def ratings(spark, sf_dir) -> DataFrame:
    """``user_id, item_id, score, ts, l_linestatus``: each order line with its customer."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id")
    )
    return lookup_join(item_ratings(spark, sf_dir), orders, "l_orderkey").drop("l_orderkey")


def items(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"),
        split_list(F.col("p_name"), " ").alias("genres"),
    )


def users(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.lower(F.substring("c_mktsegment", 1, 1)).alias("gender"),
        (F.col("c_nationkey") * 3).alias("age"),
        F.col("c_nationkey").cast("string").alias("occupation_id"),
    )


def codes(spark, sf_dir) -> DataFrame:
    """Names for the codes 0 to 4; the users' codes go up to 24."""
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("string").alias("code"), F.col("r_name").alias("name")
    )


# Reviews: a document is a review, its label the sentiment.


def reviews(spark, sf_dir) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("review"),
        F.col("lang").alias("category"), F.col("source").alias("aspect"),
    ))


def labelled_reviews(spark, sf_dir) -> DataFrame:
    sentiment = F.when(F.col("quality") == 1, "positive").otherwise("negative")
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), sentiment.alias("sentiment")
    )
    return lookup_join(reviews(spark, sf_dir), labels, "id", "left")


def turns(spark, sf_dir) -> DataFrame:
    """Turns of a conversation share its id."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("id"), F.col("text").alias("review"), F.col("role").alias("category")
    )


def stop_words(spark) -> DataFrame:
    rows = ", ".join(f"('{w}')" for w in STOP_WORDS)
    return spark.sql(f"SELECT word FROM VALUES {rows} AS t(word)")


# Orders.


def orders(spark, sf_dir) -> DataFrame:
    carrier = F.when(
        F.col("o_orderstatus") != "P", F.date_add(F.col("o_orderdate").cast("date"), 60)
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_trx_id"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        carrier.alias("order_delivered_carrier_date"),
    )


def customers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_trx_id"), F.col("c_name").alias("subscriber_id"),
        F.col("c_nationkey").alias("customer_country"),
    )


def order_items(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"), F.col("l_extendedprice").alias("price"),
        (F.col("l_tax") * 100).alias("freight_value"), F.col("l_shipdate").alias("shipping_limit_date"),
    )


def products(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category_name")
    )


def scored_events(spark, sf_dir) -> DataFrame:
    """Scores as text, some with blanks around them and some with a unit."""
    k = F.get_json_object("props", "$.k")
    score = (
        F.when(F.col("event_type") == "error", F.concat(k, F.lit(" pts")))
        .when(F.col("event_type") == "signup", F.concat(F.lit(" "), k, F.lit(" ")))
        .otherwise(k)
    )
    return table(spark, sf_dir, "events").select("event_id", score.alias("review_score"))


# Detections: an event is a frame of the camera named by its type.


def frames(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("camera_id"), F.col("event_id").cast("int").alias("frame_id"),
        epoch(F.col("ts")).alias("timestamp"), F.lit(640).alias("width"), F.lit(480).alias("height"),
        encode_base64(F.col("props").cast("binary")).alias("image_data"),
    )


def results(spark, sf_dir) -> DataFrame:
    moment = epoch(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("camera_id"), F.col("event_id").cast("int").alias("frame_id"),
        F.get_json_object("props", "$.k").cast("int").alias("person_count"),
        F.col("value").alias("processing_time_ms"), moment.alias("processed_timestamp"),
        moment.alias("stored_at"),
        encode_base64(F.col("props").cast("binary")).alias("annotated_image"),
    )


def detections(spark, sf_dir) -> DataFrame:
    """One detection per vector element: classes alternate, the size gives the confidence."""
    found = F.transform(
        F.col("embedding"),
        lambda x, i: F.struct(
            (i % 2).cast("int").alias("class_id"),
            (F.abs(x.cast("double")) * 2).alias("confidence"),
            (x.cast("double") * 100).alias("x1"), (x.cast("double") * 200).alias("y1"),
            (x.cast("double") * 300).alias("x2"), (x.cast("double") * 400).alias("y2"),
        ),
    )
    return table(spark, sf_dir, "embeddings").select("vec_id", found.alias("detections"))
