"""Boilerplate lines by their share of the pages of a site."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywood.llm.common import materialize, partitions

# A line on more than this share of a site's pages is boilerplate, if on so many pages at least.
RATIO = 0.1
LEAST_PAGES = 3

# Elements without text of the page, and those that do not end a line. A tag ends
# where another begins, and what a page leaves open is closed behind its end, so that every pattern
# reads a sign once.
HIDDEN = r"(?is)<(?:!--.*?-->|script\b.*?</script\s*>|style\b.*?</style\s*>|title\b.*?</title\s*>)"
CLOSERS = "</script></style></title><!---->"
INLINE = r"(?i)</?(?:a|b|i|u|em|strong|span|code|small|sub|sup)(?:\s[^<>]*)?>"
TAG = r"<[^<>]*>"
BLANKS = " \t\r\f"
ENTITIES = [("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")]
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def host_of(url: Column) -> Column:
    """Host of a URL in lower case; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def page_text(html: Column) -> Column:
    """Visible text of a page, a line for each block.

    A comment, script, style or title that is not closed hides the rest of the page; a ``<``
    without a ``>`` before the next ``<`` is text. Each pattern passes over a page once.
    """
    text = F.regexp_replace(F.concat(html, F.lit(CLOSERS)), HIDDEN, "\n")
    text = F.regexp_replace(F.regexp_replace(text, INLINE, ""), TAG, "\n")
    for entity, sign in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(sign))
    lines = F.transform(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)))
    return F.array_join(F.filter(lines, lambda line: line != ""), "\n")


def _key(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(" \t\r")))


def _lines(text: Column) -> Column:
    """The keys of the visible lines of a text, each once; lines are compared by a 64-bit hash."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.array_distinct(F.transform(F.filter(lines, lambda line: F.btrim(line, F.lit(" \t\r")) != ""), _key))


def _site(site: str) -> Column:
    return F.coalesce(F.col(site), F.lit(""))


def boilerplate(
    pages: DataFrame, site: str, text: str, ratio: float = RATIO, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """``__site, __lines, pages``: of each site with boilerplate the keys of its boilerplate lines.

    A line counts once for a page, without the blanks around it; blank lines do not count. Counts
    are combined within a task before they are shuffled, so a site or a line with any share of the
    rows arrives as one row per task.
    """
    rows = pages.select(_site(site).alias("__site"), _lines(F.col(text)).alias("keys"))
    # The key of no line stands for the page itself, so that one aggregate counts both.
    seen = rows.select("__site", F.explode(F.concat(F.array(F.lit(None).cast("long")), "keys")).alias("key"))
    counts = materialize(seen.groupBy("__site", "key").agg(F.count("*").alias("n")).where(F.col("key").isNull() | (F.col("n") >= least_pages)))
    totals = counts.where(F.col("key").isNull()).select("__site", F.col("n").alias("pages"))
    frequent = counts.where(F.col("key").isNotNull()).join(totals, "__site")
    return _lists(frequent.where(F.col("n") > ratio * F.col("pages")))


def _lists(frequent: DataFrame) -> DataFrame:
    # A page has so many lines, so a site has no more than these over the ratio in such a list.
    return frequent.groupBy("__site").agg(F.sort_array(F.collect_list("key")).alias("__lines"), F.max("pages").alias("pages"))


def _with_lists(pages: DataFrame, known: DataFrame, site: str, text: str) -> DataFrame:
    """Pages with ``__site, __lines`` of their site, ``__lines`` null where it has no boilerplate.

    The lists meet the pages by a broadcast where Spark finds them small enough, otherwise by a
    join in which a site with many pages is dealt out in pieces.
    """
    parts = partitions(pages.sparkSession)
    everything = known.agg(F.sum("pages")).first()[0] or 0
    # At most ``parts`` sites have more than that share of the pages counted here.
    pieces = F.ceil(F.col("pages") * parts / F.lit(max(everything, 1))).cast("int")
    large = F.broadcast(known.select(F.col("__site"), pieces.alias("__pieces")).where("__pieces > 1"))
    left = pages.withColumn("__site", _site(site)).join(large, "__site", "left")
    left = left.withColumn("__piece", F.coalesce(F.pmod(F.xxhash64(text), F.col("__pieces")), F.lit(0)).cast("int"))
    right = known.select("__site", "__lines", F.explode(F.sequence(F.lit(0), F.greatest(pieces, F.lit(1)) - 1)).alias("__piece"))
    return left.join(right, ["__site", "__piece"], "left")


def once_for_a_group(
    pages: DataFrame, known: DataFrame, grouped: Callable[[DataFrame], DataFrame], site: str, text: str,
    ratio: float, least_pages: int,
) -> DataFrame:
    """The part of ``known`` that still is boilerplate if a group of pages counts as one page.

    ``grouped`` gets the pages that hold a line of ``known`` with columns ``site, text`` and
    returns ``__site, __lines, __group``. Only their groups matter, since a line is on no more
    groups than pages.
    """
    held = F.array_intersect(_lines(F.col(text)), F.col("__lines"))
    pages = _with_lists(pages.select(site, text), known, site, text).withColumn("__lines", held)
    holding = pages.where(F.size("__lines") > 0).select("__site", "__lines", F.col(text).alias("text"))
    holding = grouped(materialize(holding))
    # A group may hold a third of all pages: it is combined within tasks before each shuffle.
    each = holding.select("__site", F.explode("__lines").alias("key"), "__group").distinct()
    counts = each.groupBy("__site", "key").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)
    return _lists(counts.join(known.select("__site", "pages"), "__site").where(F.col("n") > ratio * F.col("pages")))


def drop_boilerplate(
    pages: DataFrame, site: str, text: str, ratio: float = RATIO, least_pages: int = LEAST_PAGES,
    keep_whole: bool = False, grouped: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """All rows and columns with ``text`` without its boilerplate lines, and two more columns.

    ``n_lines`` counts the lines of the text, ``n_dropped`` those taken out. Other lines stay as
    they are, blank ones too. With ``keep_whole`` a text of which no visible line would be left
    stays whole: it is a copy of other pages rather than a page around boilerplate. ``grouped``
    names groups of pages that count as one page each, as in ``once_for_a_group``. Rows without a
    site form a site of their own; a null text stays null with no lines. Columns of the input that
    are named like the two new ones give way to them.
    """
    known = materialize(boilerplate(pages, site, text, ratio, least_pages))
    if grouped:
        known = materialize(once_for_a_group(pages, known, grouped, site, text, ratio, least_pages))
    both = _with_lists(pages, known, site, text).withColumn("__all", F.split(text, "\n"))
    # The few lines of the page that are on the list, found at once however long it is.
    held = both.withColumn("__held", F.array_intersect(F.transform("__all", _key), F.col("__lines")))
    is_kept = F.when(F.col("__lines").isNull() | (F.size("__held") == 0), F.col("__all")).otherwise(
        F.filter("__all", lambda line: ~F.array_contains("__held", _key(line)))
    )
    both = held.withColumn("__kept", is_kept)
    if keep_whole:
        left_over = F.exists("__kept", lambda line: F.btrim(line, F.lit(" \t\r")) != "")
        both = both.withColumn("__kept", F.when(left_over, F.col("__kept")).otherwise(F.col("__all")))
    n_lines = F.coalesce(F.size("__all"), F.lit(0))
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(n_lines).cast("long")
    n_kept = F.when(F.col(text).isNull(), 0).otherwise(F.size("__kept")).cast("long")
    cleaned = F.array_join("__kept", "\n").alias(text)
    ordered = [cleaned if c == text else F.col(c) for c in pages.columns if c not in ("n_lines", "n_dropped")]
    return both.select(*ordered, n_lines.alias("n_lines"), (n_lines - n_kept).alias("n_dropped"))
