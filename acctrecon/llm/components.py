"""Connected components of an edge table, by alternating star steps.

Each round points every node's larger neighbours, then its smaller ones, to
the smallest node that it knows.  Both steps are a grouped minimum and an
equi-join; the minimum is cut to a table first, so that the join reads two
plain exchanges and a hub's edges can be split over tasks.  The number of
rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctrecon.llm.common import cut


def _toward_minimum(pairs: DataFrame, most: int) -> DataFrame:
    """pairs (u, v), at most ``most``, with m, the smallest v of u."""
    least = cut(pairs.groupBy("u").agg(F.min("v").alias("m")), "least", most)
    return pairs.join(least.withColumnRenamed("u", "k"), F.col("u") == F.col("k"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (long columns a, b):
    component is the smallest node that links reach.  Loops and nulls are
    ignored; repeated edges count once; no edges give no rows."""
    cur = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
              .distinct(), "edges")
    # no step makes more rows than twice the pairs it reads
    if most := 2 * cur.count():
        while True:
            both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
            large = cut(_toward_minimum(both, most).where("v > u")
                        .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct(), "large", most)
            near = _toward_minimum(large, most)
            cur = cut(near.select(F.explode(F.array(
                F.struct(F.col("u"), F.col("m").alias("v")),
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                .select("e.u", "e.v").where("u <> v").distinct(), "small", most)
            roots = cur.select(F.col("v").alias("r")).distinct()
            if cur.join(roots, F.col("u") == F.col("r"), "left_semi").isEmpty():
                break
    stars = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
