"""Distinct counts in parts against count_distinct."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallywood.operators import distinct, ranking


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_parts_count_as_the_whole(spark, seed):
    rng = random.Random(seed)
    keys = [None, 0, 1, -1, -40_000, 32_767, 32_768, 32_769, 2**40, 2**62, *range(100, 160)]
    data = [(rng.choice(["a", "b", None]), rng.choice(keys)) for _ in range(900)] + [("none", None)]
    df = spark.createDataFrame(data, "g string, k long")
    batches = [df.where(F.col("k").isNull() | (F.pmod("k", F.lit(3)) != i)) for i in range(3)]
    parts = distinct.distinct_parts(batches[0], ["g"], "k")
    for batch in batches[1:]:
        parts = distinct.merge_parts(parts.unionByName(distinct.distinct_parts(batch, ["g"], "k")), ["g"])
    got = distinct.distinct_counts(parts, ["g"], "n")
    want = df.groupBy("g").agg(F.count_distinct("k").alias("n"))
    assert sorted(rows(got), key=str) == sorted(rows(want), key=str)


def test_no_parts(spark):
    empty = distinct.distinct_parts(spark.createDataFrame([], "g string, k long"), ["g"], "k")
    assert distinct.distinct_counts(empty, ["g"], "n").collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_ranks_of_chosen_values(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([None, float(rng.randrange(30))]) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    chosen = [*rng.sample(values, 9), None]
    known = sorted({v for v in values if v is not None}, reverse=True)
    want = {v: known.index(v) + 1 if v is not None else len(known) + 1 for v in chosen}
    assert ranking.dense_ranks_of(df, "x", chosen) == want
    assert ranking.dense_ranks_of(df, "x", [None]) == {None: len(known) + 1}
