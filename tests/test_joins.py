import pytest
from conftest import rows

from pyspark.sql import functions as F

from tallywood.operators import joins


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows have key 0, some have none, the rest are spread over 97 keys."""
    n = spark.range(0, 30000, numPartitions=12)
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 31 == 0, None).otherwise(F.col("id") % 97 + 1)
    return n.select(key.cast("bigint").alias("k"), F.col("id").alias("v"))


@pytest.fixture(scope="module")
def dim(spark):
    """Keys 0 to 79, the key 5 twice."""
    return spark.range(0, 80).select(F.col("id").alias("k"), (F.col("id") * 10).alias("d")).union(
        spark.sql("SELECT 5L AS k, -1L AS d"))


@pytest.fixture
def shuffled(spark):
    """Broadcasts off, and limits of adaptive execution that suit small tables."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def tasks_of_key(df):
    """Tasks that hold rows of the key; a plain filter would move below the join."""
    held = df.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count_if(F.col("k") == 0).alias("n"), F.max("v").alias("v"))  # a column that fills bytes
    return sum(n > 0 for _, n, _ in rows(held))


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_rows_of_a_hot_key_are_spread(spark, facts, dim, shuffled, how):
    joined = joins.lookup_join(facts, dim if how != "left_anti" else dim.where("k > 0"), "k", how)
    assert tasks_of_key(joined) >= 3


def test_facts_out_of_a_join_on_the_key_are_spread(facts, dim, shuffled):
    once = joins.lookup_join(facts, dim, "k", "left")
    assert tasks_of_key(joins.lookup_join(once, dim.withColumnRenamed("d", "e"), "k")) >= 3


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_both_ways_give_the_same_rows(spark, facts, dim, how):
    small = sorted(rows(joins.lookup_join(facts, dim, "k", how)), key=str)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(rows(joins.lookup_join(facts, dim, "k", how)), key=str) == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_building_a_join_runs_no_job(spark, facts, dim):
    spark.sparkContext.setJobGroup("building", "")
    try:
        joins.lookup_join(facts, dim, "k")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_one_row_per_key(spark):
    dim = spark.sql("SELECT * FROM VALUES (1, 'b', 1), (1, 'a', 2), (2, 'c', 1) AS t(k, name, position)")
    assert sorted(rows(joins.one_row_per_key(dim, "k", "name"))) == [(1, "a"), (2, "c")]
    assert sorted(rows(joins.one_row_per_key(dim.drop("position"), "k", "name"))) == [(1, "b"), (2, "c")]
