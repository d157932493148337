"""Text formats: the test tables are written in each format, read back and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywood.functions.text import without_prefix
from tallywood.plans import reviews as review_plans
from tallywood.session import fresh_dir
from tallywood.sinks import text as sinks
from tallywood.sources import orders as order_sources
from tallywood.sources import ratings as rating_sources
from tallywood.sources import reviews as review_sources
from workload import ratings as rating_queries
from workload import reviews as review_queries
from workload import views
from workload.sql import tokens


def _written(df, label: str) -> str:
    path = fresh_dir(df.sparkSession, label)
    df.write.text(path)
    return path


def parsed_ratings(spark, d):
    """Two inputs with different delimiters; a line without a discount has no valid score."""
    lines = views.table(spark, d, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("user"), F.col("l_partkey").cast("string").alias("item"),
        F.when(F.col("l_discount") == 0, "none").otherwise(F.col("l_quantity").cast("string")).alias("score"),
        F.concat(F.lit(" "), F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).cast("string"), F.lit("\t")).alias("ts"),
        "l_linestatus",
    )
    paths = [
        _written(lines.where(F.col("l_linestatus") == status).select(F.concat_ws(sep, "user", "item", "score", "ts")), "ratings")
        for status, sep in (("O", ","), ("F", "::"))
    ]
    return rating_sources.read_ratings(spark, paths)


def parsed_items(spark, d):
    """Titles with a comma of their own; genres with empty entries between the bars."""
    lines = views.table(spark, d, "part").select(
        F.concat("p_partkey", F.lit(","), "p_name", F.lit(", the "), F.lit(","), "p_brand", F.lit("| |"), "p_type", F.lit("|"))
    )
    found = rating_sources.read_items(spark, _written(lines, "items"))
    return found.select("item_id", "title", F.concat_ws("/", "genres").alias("genres"))


def parsed_users(spark, d):
    """Balances stand in for the age: only whole numbers are kept."""
    age = F.when(F.col("c_mktsegment") == "BUILDING", "unknown").otherwise(F.col("c_nationkey").cast("string"))
    lines = views.table(spark, d, "customer").select(
        F.concat_ws(",", "c_custkey", F.substring("c_mktsegment", 1, 1), age, "c_nationkey", "c_name")
    )
    return rating_sources.read_users(spark, _written(lines, "users"))


def parsed_codes(spark, d):
    """All three delimiters in one file, each cut at its first occurrence."""
    sep = F.when(F.col("n_regionkey") == 0, "::").when(F.col("n_regionkey") == 1, "\t").otherwise(",")
    lines = views.table(spark, d, "nation").select(F.concat("n_nationkey", sep, "n_name", sep, "n_regionkey"))
    return rating_sources.read_codes(spark, _written(lines, "codes")).select("code", "name")


def _review_lines(spark, d):
    """One line per review; Spanish reviews get an id that is no number."""
    number = F.when(F.col("lang") == "es", F.concat(F.lit("x"), "doc_id")).otherwise(F.col("doc_id").cast("string"))
    one_line = F.regexp_replace("text", "[\r\n;]+", " ")
    return views.table(spark, d, "documents").select(
        F.concat_ws(";", number, one_line, "lang", "source", F.lit("neutral"))
    )


def parsed_reviews(spark, d):
    found = review_sources.read_reviews(spark, _written(_review_lines(spark, d), "reviews"))
    return found.select(
        "id", F.md5(F.col("review").cast("binary")).alias("review_md5"), "category", "aspect", "sentiment"
    )


def reviews_counted(spark, d):
    """Rows without a readable id are not counted."""
    found = review_sources.read_reviews(spark, _written(_review_lines(spark, d), "reviews"))
    return review_plans.rows_by(found, "category")


def stored_tokens(spark, d):
    """Tokens stored as text and loaded again for counting."""
    found = review_plans.tokens(views.turns(spark, d)).select("id", "word")
    path = fresh_dir(spark, "tokens")
    sinks.write_delimited(found, path)
    loaded = review_sources.read_tokens(spark, path)
    return loaded.groupBy("id", "word").agg(F.count("*").alias("n"))


def stop_words_from_file(spark, d):
    """The words of the benchmark texts as a word list of their own, one per line."""
    benchmark = views.table(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("review"))
    listed = review_plans.tokens(benchmark).select("word").distinct()
    stop_words = review_sources.read_stop_words(spark, _written(listed, "words"))
    return review_plans.word_frequencies(review_queries.text_tokens(spark, d), stop_words, above=20)


def header_csv(spark, d):
    """Orders as a header CSV, read with a declared schema."""
    path = fresh_dir(spark, "orders")
    sinks.write_header_csv(views.table(spark, d, "orders"), path)
    schema = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp, o_orderpriority string")
    found = order_sources.read_table(spark, path, schema)
    return found.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


def inferred_schema(spark, d):
    """Header CSVs of three tables with inferred types, reported as rows."""
    found = {}
    for name in ("customer", "orders", "part"):
        path = fresh_dir(spark, name)
        sinks.write_header_csv(views.table(spark, d, name), path)
        found[name] = order_sources.read_inferred(spark, path)
    return order_sources.schema_report(spark, found).select("table", "ordinal", "column", "type")


def key_value_file(spark, d):
    path = fresh_dir(spark, "lines")
    sinks.write_key_value(rating_queries.genre_sentences(spark, d), path, "key", "value", " ")
    return spark.read.text(path).withColumnRenamed("value", "line")


def delimited_file(spark, d):
    path = fresh_dir(spark, "counts")
    sinks.write_delimited(review_plans.rows_by(views.reviews(spark, d), "aspect"), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def prefixed_addresses(spark, d):
    """Addresses after a scheme; those with the other scheme have none."""
    address = F.col("url")
    return views.table(spark, d, "pages").select(
        "page_id", without_prefix(address, "https://").alias("secure"),
        without_prefix(address, "http://").alias("plain"),
    )


def preview_rows(spark, d):
    """The first rows of an ordered answer."""
    return sinks.preview(rating_queries.by_item_gender(spark, d), 20)


REVIEW_ID_SQL = "CASE WHEN lang <> 'es' THEN CAST(doc_id AS INTEGER) END"

QUERIES = {
    "text_parse_ratings": (
        parsed_ratings,
        "SELECT l_suppkey AS user_id, l_partkey AS item_id, l_quantity AS score, "
        "CAST(epoch(l_shipdate) AS BIGINT) AS ts FROM lineitem WHERE l_discount <> 0"),
    "text_parse_items": (
        parsed_items,
        "SELECT p_partkey AS item_id, p_name || ', the' AS title, p_brand || '/' || p_type AS genres FROM part"),
    "text_parse_users": (
        parsed_users,
        "SELECT c_custkey AS user_id, substr(c_mktsegment, 1, 1) AS gender, c_nationkey AS age, "
        "CAST(c_nationkey AS VARCHAR) AS occupation_id, c_name AS zip FROM customer WHERE c_mktsegment <> 'BUILDING'"),
    "text_parse_codes": (
        parsed_codes,
        "SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name || CASE n_regionkey WHEN 0 THEN '::' WHEN 1 THEN chr(9) ELSE ',' END "
        "|| CAST(n_regionkey AS VARCHAR) AS name FROM nation"),
    "text_parse_reviews": (
        parsed_reviews,
        rf"SELECT {REVIEW_ID_SQL} AS id, md5(regexp_replace(text, '[\r\n;]+', ' ', 'g')) AS review_md5, "
        "lang AS category, source AS aspect, 'neutral' AS sentiment FROM documents"),
    "reviews_without_id_uncounted": (
        reviews_counted,
        f"SELECT lang AS category, count({REVIEW_ID_SQL}) AS n FROM documents GROUP BY lang"),
    "text_parse_tokens": (
        stored_tokens,
        f"SELECT CAST(id AS INTEGER) AS id, word, count(*) AS n FROM {tokens('conversations', 'conv_id')} GROUP BY id, word"),
    "stop_words_from_file": (
        stop_words_from_file,
        f"SELECT word, count(*) AS freq FROM {tokens('documents', 'doc_id')} "
        f"WHERE word NOT IN (SELECT word FROM {tokens('benchmark', 'item_id')}) GROUP BY word HAVING count(*) > 20"),
    "header_csv_declared": (header_csv, "SELECT * FROM orders"),
    "header_csv_inferred": (
        inferred_schema,
        """SELECT table_name AS "table", CAST(ordinal_position AS INTEGER) AS ordinal, column_name AS "column",
  CASE data_type WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'int' WHEN 'VARCHAR' THEN 'string'
    WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp' ELSE data_type END AS type
FROM information_schema.columns WHERE table_name IN ('customer', 'orders', 'part')"""),
    "key_value_file": (
        key_value_file, f"SELECT key || ' ' || value AS line FROM ({rating_queries.QUERIES['key_value_genres'][1]})"),
    "delimited_file": (
        delimited_file, "SELECT source || ',' || CAST(count(*) AS VARCHAR) AS line FROM documents GROUP BY source"),
    "text_without_prefix": (
        prefixed_addresses,
        "SELECT page_id, CASE WHEN starts_with(url, 'https://') THEN substr(url, 9) END AS secure, "
        "CASE WHEN starts_with(url, 'http://') THEN substr(url, 8) END AS plain FROM pages"),
    "preview_rows": (
        preview_rows, f"SELECT * FROM ({rating_queries.BY_GENDER_SQL}) ORDER BY item_id, gender LIMIT 20"),
}
