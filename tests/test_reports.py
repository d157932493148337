from conftest import rows

from tallywood.plans import reports
from tallywood.sinks import report, text


def test_item_lines(spark):
    means = spark.sql("SELECT 'Tên phim' AS title, 3.125D AS avg_rating, 12L AS n_ratings")
    assert rows(reports.item_lines(means)) == [("Tên phim" + " " * 57 + " " + "      3.12" + " " + "      12",)]


def test_group_lines_keep_long_names(spark):
    means = spark.sql("SELECT 'a very long genre name' AS genre, 4.0D AS avg_rating, 1L AS n_ratings")
    assert rows(reports.group_lines(means, "genre", (5, 6, 3))) == [("a very long genre name   4.00   1",)]


def test_sentences_round_half_up(spark):
    means = spark.sql("SELECT 'T' AS title, 'G' AS genre, 3.125D AS avg_rating, 7L AS n_ratings")
    assert rows(reports.item_key_values(means)) == [("T", "Average rating: 3.13 (Total ratings: 7)")]
    assert rows(reports.genre_key_values(means)) == [("G", "Avg: 3.13,  Count: 7")]
    assert rows(reports.best_item_key_value(means))[0][1].startswith("is the highest rated movie with an average rating of 3.13 ")


def test_heading():
    assert report.heading(["A", "B"], [4, -4], "-", 9) == ["-" * 9, "A       B", "-" * 9]


def test_key_value_file(spark, tmp_path):
    df = spark.sql("SELECT 'k' AS k, 1 AS v")
    text.write_key_value(df, str(tmp_path / "tab"), "k", "v")
    assert rows(spark.read.text(str(tmp_path / "tab"))) == [("k\t1",)]


def test_delimited_lines(spark):
    df = spark.sql("SELECT 'a,b' AS x, CAST(NULL AS INT) AS y, array(named_struct('p', 1, 'q', CAST(NULL AS STRING))) AS bag")
    assert rows(text.delimited_lines(df)) == [("a,b,,{(1,)}",)]


def test_ordered_report_file(spark, tmp_path):
    lines = spark.range(2000).orderBy("id").selectExpr("format_string('%05d', id) AS line")
    report.write_report(lines, str(tmp_path / "r"))
    parts = sorted((tmp_path / "r").glob("part-*"))
    written = [line for part in parts for line in part.read_text().splitlines()]
    assert written == sorted(written) and len(written) == 2000


def test_whole_report_in_order(spark):
    means = spark.sql("SELECT concat('T', id) AS title, 5 - id / 100 AS avg_rating, 7L AS n_ratings FROM range(0, 60, 1, 5)").orderBy("avg_rating", ascending=False)
    lines = [r[0] for r in rows(reports.item_report(means, reports.best_item_lines(means.limit(1))))]
    assert lines[0] == lines[2] == "=" * 85 and lines[1].startswith("Title") and lines[1].endswith("Avg Rating  Ratings")
    assert [line.split()[0] for line in lines[3:63]] == [f"T{i}" for i in range(60)]
    assert lines[63:] == ["", "=" * 85, "Best item with at least 5 ratings:", "Title: T0", "Average: 5.00", "Ratings: 7", "=" * 85]
