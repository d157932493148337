"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywood.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``a, b`` links; the component is its least node.

    Rounds of two steps, as in the alternating star algorithm: every node points its larger
    neighbours, and itself, at the least node it knows. A star of any size is done at once and a
    chain halves with each round. Least nodes are combined within tasks before they are shuffled,
    and each round is written to the shared folder, so that lost executors cost one round.
    """
    pairs = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs, before = materialize(pairs), None
    while True:
        # Towards smaller nodes, for larger neighbours only.
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.where("a != b").distinct()
        # Then for the smaller neighbours and the node itself.
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b"))
        )
        pairs = materialize(small.where("a != b").distinct())
        state = pairs.agg(F.count("*"), F.sum(F.hash("a", "b")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
        before = state
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
