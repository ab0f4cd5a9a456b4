"""Connected components of a link table by alternating star steps.

Every step is an aggregate and a join on the node, both split by Spark: a
node with very many links is folded map-side and its join partition divided
by AQE. After a logarithmic number of rounds the links form stars around the
smallest node of each component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise


def connected_components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root) for every node with a link; root is its component's smallest node.

    Links are undirected. Null ends, loops and repeated links change nothing;
    an empty table gives an empty result. Rounds are written below the shared
    checkpoint folder, so that a lost executor costs one round at most.
    """
    spark = links.sparkSession
    pairs = (links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
             .where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    pairs = materialise(spark, pairs, "links")
    before = None
    while True:
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        pairs = materialise(spark, _small_star(_large_star(pairs)), "links")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to the smallest of the node and its neighbours."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(pairs: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = pairs.join(least, "u").select(
        F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        .alias("p")).select("p.*")
    return moved.where(F.col("u") != F.col("v")).distinct()
