from conftest import rows

from pyspark.sql import functions as F

from tallywood.sources import orders, ratings, reviews
from tallywood.sources.detections import documents, topic_options
from tallywood.functions.documents import FRAME_SCHEMA


def test_ratings_keep_only_readable_lines(spark, text_file):
    path = text_file("r.txt", [
        "1,10,4.5,1577836800", "", "  2 , 10 , 3 , 1577836801  ", "3::11::2.5::1577836802",
        "4,10,5", "x,10,4,1", "4,y,4,1", "4,10,bad,1", "4,10,4,soon", "4,10,4.0f,1", "4,10,4,1.5",
        "5,11,1e0,7,extra,fields", "6,11,.5,-8",
    ], end="\r\n", last=False)
    assert sorted(rows(ratings.read_ratings(spark, path))) == [
        (1, 10, 4.5, 1577836800), (2, 10, 3.0, 1577836801), (3, 11, 2.5, 1577836802),
        (5, 11, 1.0, 7), (6, 11, 0.5, -8),
    ]


def test_ratings_without_a_time(spark, text_file):
    path = text_file("t.txt", ["1,10,4.5", "2,10,3,soon", "3,10", "4,10,bad,1", "5,10,2,9"])
    assert sorted(rows(ratings.read_ratings(spark, path, timed=False))) == [
        (1, 10, 4.5, None), (2, 10, 3.0, None), (5, 10, 2.0, 9)]


def test_several_files_are_read_on_their_own(spark, text_file):
    """Without a newline at the end of a file its last line must not run into the next one."""
    first = text_file("a.txt", ["1,1,1,1"], last=False)
    second = text_file("b.txt", ["2,2,2,2"], last=False)
    assert sorted(rows(ratings.read_ratings(spark, [first, second]))) == [(1, 1, 1.0, 1), (2, 2, 2.0, 2)]


def test_items_with_commas_and_empty_genres(spark, text_file):
    path = text_file("i.txt", [
        "1,Plain (1990),Drama", "2,Name, The (1995), Comedy | |Drama|", "3::Long: A::War|Sport",
        "4,no genres", "x,Title,Drama", "5,Empty,",
    ])
    found = ratings.read_items(spark, path).drop("position")
    assert sorted(rows(found)) == [
        (1, "Plain (1990)", ["Drama"]), (2, "Name, The (1995)", ["Comedy", "Drama"]),
        (3, "Long: A", ["War", "Sport"]), (5, "Empty", []),
    ]


def test_users_need_five_fields(spark, text_file):
    path = text_file("u.txt", ["1,M,28,3,12345", "2,f, 35 ,7,", "3,M,old,2,1", "4,M,20,3", "5::F::40::9::z"])
    assert sorted(rows(ratings.read_users(spark, path))) == [
        (1, "M", 28, "3", "12345"), (2, "f", 35, "7", ""), (5, "F", 40, "9", "z"),
    ]


def test_codes_with_three_delimiters(spark, text_file):
    path = text_file("c.txt", ["1,a, b", "2\tc,d", "3::e\tf", "alone"])
    assert sorted(rows(ratings.read_codes(spark, path).drop("position"))) == [
        ("1", "a, b"), ("2", "c,d"), ("3", "e\tf"),
    ]


def test_position_follows_the_file(spark, text_file):
    path = text_file("p.txt", [f"{i % 2},name{i}" for i in range(50)])
    last = ratings.read_codes(spark, path).groupBy("code").agg(F.max_by("name", "position"))
    assert sorted(rows(last)) == [("0", "name48"), ("1", "name49")]


def test_reviews_without_quoting(spark, text_file):
    path = text_file("h.csv", [
        "id;review;category;aspect;sentiment", '1;"quoted" text;A;B;positive', "x;bad id;A;B;negative",
        "2;short line", "3;one;A;B;positive;extra", "4;back\\slash;A;B;positive",
    ])
    assert rows(reviews.read_reviews(spark, path)) == [
        (None, "review", "category", "aspect", "sentiment"),
        (1, '"quoted" text', "A", "B", "positive"), (None, "bad id", "A", "B", "negative"),
        (2, "short line", None, None, None), (3, "one", "A", "B", "positive"),
        (4, "back\\slash", "A", "B", "positive"),
    ]


def test_header_csv_declared_and_inferred(spark, text_file):
    path = text_file("items.csv", [
        "Order_ID;Order_Item_ID;Product_ID;Seller_ID;Shipping_Limit_Date;Price;Freight_Value",
        "a;1;p;s;2024-01-02 03:04:05;10.5;2", "b;2;p;s;;9;1.25",
    ])
    declared = orders.read_table(spark, path, orders.SCHEMAS["items"])
    inferred = orders.read_inferred(spark, path)
    assert rows(declared) == rows(inferred)
    report = orders.schema_report(spark, {"items": inferred}).where(F.col("ordinal").isin(1, 2, 5, 6))
    assert rows(report) == [
        ("items", 1, "Order_ID", "string", True), ("items", 2, "Order_Item_ID", "int", True),
        ("items", 5, "Shipping_Limit_Date", "timestamp", True), ("items", 6, "Price", "double", True),
    ]


def test_documents_that_do_not_parse_are_dropped(spark):
    good = '{"camera_id":"c","frame_id":1,"timestamp":1.5,"width":2,"height":3,"image_data":"eA=="}'
    messages = spark.createDataFrame([(good,), ("{broken",), ("[]",)], "value string")
    assert rows(documents(messages, FRAME_SCHEMA)) == [("c", 1, 1.5, 2, 3, "eA==")]


def test_topic_reads_start_at_the_newest_message():
    assert topic_options("h:1", "t")["startingOffsets"] == "latest"
    options = topic_options("h:1", "t", "earliest", tasks=40, per_trigger=1000)
    assert (options["minPartitions"], options["maxOffsetsPerTrigger"], options["startingOffsets"]) == ("40", "1000", "earliest")
