import random

import pytest
from conftest import rows

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallywood.operators import ranking


@pytest.mark.parametrize("seed, distinct", [(1, 5), (2, 60), (3, 100000)])
@pytest.mark.parametrize("buckets", [1, 4, 7])
def test_global_dense_rank_equals_one_window(spark, seed, distinct, buckets):
    rng = random.Random(seed)
    data = [(i, rng.choice([None, 7.25, float(rng.randrange(distinct))])) for i in range(500)]
    df = spark.createDataFrame(data, "id int, x double")
    plain = df.withColumn("r", F.dense_rank().over(Window.orderBy(F.desc("x"))).cast("bigint"))
    assert sorted(rows(ranking.global_dense_rank(df, "x", "r", buckets)), key=str) == sorted(rows(plain), key=str)


def test_global_dense_rank_of_nothing(spark):
    df = spark.createDataFrame([], "id int, x double")
    assert rows(ranking.global_dense_rank(df, "x", "r")) == []


def test_top_n_keeps_the_plan_small(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id"))
    top = ranking.top_n_per_group(df, "g", [F.desc("id")], 2)
    assert sorted(rows(top)) == [(0, 96, 2), (0, 99, 1), (1, 94, 2), (1, 97, 1), (2, 95, 2), (2, 98, 1)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_newest_with_zero_returns_all(spark):
    df = spark.range(30).select(F.col("id").alias("stored_at"), F.lit("c").alias("camera_id"), F.col("id").alias("frame_id"))
    assert ranking.newest(df, 0).count() == 30
    assert [r[0] for r in rows(ranking.newest(df, 2))] == [29, 28]
