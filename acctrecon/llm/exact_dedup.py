"""Exact dedup with a heavy-hitter split, in DataFrame functions only.

1. Every text is hashed once (SHA-256 of its UTF-8) into a narrow table.
2. A counter summary of the Misra-Gries family (Spark's approx_top_k states,
   merged in a tree of two levels) names at most ``tracked`` digests that may
   be frequent, in memory that does not grow with the data.
3. Their exact sizes and winners are counted; map-side partial sums leave one
   row per digest and task.  The verified winners, at most ``k`` rows, are
   broadcast, and the copies of a frequent digest are settled without a
   shuffle.
4. The remaining digests, each a small share of the rows by the summary's
   guarantee, are counted by an ordinary shuffle, and those that repeat are
   joined with their rows; a digest that still has many is split by the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctrecon.llm.common import cut

#: Digests that are broadcast, at most: a row has about 100 bytes.
HEAVY = 512
#: Counters of a summary.
TRACKED = 4096
#: Summaries merged side by side before the last merge.
FAN_IN = 64


def heavy_candidates(digests: DataFrame, k: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """At most ``k`` digests (column text_sha256) that may be frequent."""
    parts = (digests.withColumn("_lane", F.pmod(F.spark_partition_id(), F.lit(FAN_IN)))
             .groupBy("_lane").agg(F.expr(f"approx_top_k_accumulate(text_sha256, {tracked})").alias("s")))
    # grouped, as a task without rows can't hand over a state
    whole = parts.groupBy(F.lit(0).alias("_all")).agg(F.expr(f"approx_top_k_combine(s, {tracked})").alias("s"))
    return (whole.select(F.explode(F.expr(f"approx_top_k_estimate(s, {k})")).alias("t"))
            .where("t.count > 1").select(F.col("t.item").alias("text_sha256")))


def exact_dedup(docs: DataFrame, *, k: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id,
    group_size, kept, text_sha256.

    Texts are equal when identical; null is the empty text.  The largest
    doc_id of equal texts stays.  Rows that repeat a doc_id count as rows and
    share its decision; a row with a null doc_id counts in group_size and is
    kept only if its whole group has null ids (keep_id is then null).  Other
    columns are not read.  An empty table gives an empty result.
    """
    digests = cut(docs.select("doc_id", F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
                              .alias("text_sha256")), "digests")
    candidates = cut(heavy_candidates(digests, k, tracked), "candidates")
    winner = [F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")]
    heavy = cut(digests.join(F.broadcast(candidates), "text_sha256", "left_semi")
                .groupBy("text_sha256").agg(*winner).where("group_size > 1"), "winners")
    settled = digests.join(F.broadcast(heavy), "text_sha256")
    rest = digests.join(F.broadcast(heavy), "text_sha256", "left_anti")
    # written first, so that the join reads two plain exchanges
    again = cut(rest.groupBy("text_sha256").agg(*winner).where("group_size > 1"), "again")
    rest = (rest.join(again, "text_sha256", "left")
            .select("text_sha256", "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id"))
                    .otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).alias("group_size")))
    out = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return settled.withColumn("kept", kept).select(out).union(rest.withColumn("kept", kept).select(out))
