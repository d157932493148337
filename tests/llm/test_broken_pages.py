"""Pages that are not closed anywhere, a megabyte each, within seconds."""

import time

import pytest
from pyspark.sql import functions as F

from tallywood.llm import site_lines

SIZE = 1_000_000
# Pieces that a page repeats, and whether they are text.
BROKEN = {"<!--": False, "<script ": False, "<style>": False, "<title": False, "<": True, "<a ": True, " ": False, "<\n": True, "</script ": True}


@pytest.mark.parametrize("piece", BROKEN)
def test_one_pass(spark, piece):
    repeated = piece * (SIZE // len(piece))
    html = "first<p>" + repeated
    page = spark.createDataFrame([(html,)], "html string")
    started = time.time()
    got = page.select(site_lines.page_text(F.col("html")).alias("t")).first().t
    assert time.time() - started < 20
    assert got == ("first\n" + repeated.strip() if BROKEN[piece] else "first")


@pytest.mark.parametrize(("html", "text"), [
    ("a<!-- b", "a"), ("a<!-- b --> c", "a\nc"), ("a<script>b</script >c", "a\nc"), ("a <title>t", "a"),
    ("1 < 2 <p>and 3 > 2", "1 < 2\nand 3 > 2"), ("a \t\n\n \r\f b", "a\nb"), ("<a href='x'>y</a> z", "y z"), (None, None), ("", ""),
])
def test_what_is_not_closed(spark, html, text):
    page = spark.createDataFrame([(html,)], "html string")
    assert page.select(site_lines.page_text(F.col("html")).alias("t")).first().t == text
