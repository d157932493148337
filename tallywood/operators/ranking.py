"""Top rows, best rows and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywood.operators.joins import lookup_join


def top_n_per_group(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every group, with their place in ``rank``.

    Spark keeps ``n`` rows per group in each task before the shuffle, so a group of any size
    sends only a few rows on.
    """
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("rank", place).where(F.col("rank") <= n)


def nested_top_n(
    df: DataFrame, group: str, order: list[Column], n: int, fields: list[str], name: str
) -> DataFrame:
    """One row per group with its first ``n`` rows as an ordered array of structs."""
    ranked = top_n_per_group(df, group, order, n)
    rows = F.sort_array(F.collect_list(F.struct("rank", *fields)))
    kept = F.transform(rows, lambda r: F.struct(*[r[f].alias(f) for f in fields]))
    return ranked.groupBy(group).agg(kept.alias(name))


def first_row(df: DataFrame, order: list[Column]) -> DataFrame:
    """The first row in the given order; no row when there is none."""
    return df.orderBy(*order).limit(1)


def newest(results: DataFrame, n: int, moment: str = "stored_at") -> DataFrame:
    """The newest ``n`` results; 0 means all of them. Ties go by camera and frame."""
    ordered = results.orderBy(F.desc(moment), "camera_id", F.desc("frame_id"))
    return ordered.limit(n) if n else ordered


def _ranges(values: DataFrame, column: str, buckets: int) -> Column:
    """The range of a value, highest values first, by cuts that one pass over the values gives.

    The cuts are approximate quantiles; they decide how even the ranges are and nothing else.
    Equal values share a range.
    """
    points = [i / buckets for i in range(1, buckets)] or [0.5]
    cuts = values.agg(F.percentile_approx(column, points, max(10_000, 20 * buckets))).first()[0] or []
    above = F.filter(F.array(*map(F.lit, sorted(set(cuts)))), lambda cut: cut >= F.col(column)) if cuts else F.array()
    return F.size(above)


def global_dense_rank(
    df: DataFrame, column: str, name: str, buckets: int | None = None
) -> DataFrame:
    """Dense rank of a numeric column over all rows, highest first, nulls last.

    The distinct values are cut into ranges and ranked range by range, in one shuffle; a range
    starts where the counts of the higher ranges end. No task holds more than one range, and the
    table of range sizes has ``buckets`` rows (the shuffle partitions of the session). Values are
    combined within tasks before they are shuffled, and the rows themselves meet their rank by a
    join that splits a frequent value, so rows of one value may be any share of all. ``df`` is read
    several times.
    """
    if buckets is None:
        buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = df.select(column).where(F.col(column).isNotNull())
    values = known.distinct().withColumn("range", _ranges(known, column, buckets))

    in_range = F.row_number().over(Window.partitionBy("range").orderBy(F.desc(column)))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = values.groupBy("range").agg(F.count("*").alias("n"))
    starts = sizes.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    ranks = values.withColumn("place", in_range).join(F.broadcast(starts), "range")
    ranks = ranks.select(column, (F.col("start") + F.col("place")).alias(name))

    last = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)) + 1).scalar()
    ranked = lookup_join(df, ranks, column, "left")
    return ranked.withColumn(name, F.coalesce(name, last)).select(*df.columns, name)


def dense_ranks_of(df: DataFrame, column: str, chosen: list) -> dict:
    """The dense rank, highest first and nulls last, of some values among all values of a column.

    Other values only count: each distinct one falls between two of the chosen, and the counts of
    the gaps, one for each chosen value, are all that leaves the tasks.
    """
    wanted = sorted({v for v in chosen if v is not None})
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    below = F.size(F.filter(F.array(*map(F.lit, wanted)), lambda v: v < F.col(column))) if wanted else F.lit(0)
    gaps = {r["gap"]: r["n"] for r in values.groupBy(below.alias("gap")).agg(F.count("*").alias("n")).collect()}
    ranks = {v: 1 + sum(n for gap, n in gaps.items() if gap > place) for place, v in enumerate(wanted)}
    return {**ranks, None: 1 + sum(gaps.values())}
