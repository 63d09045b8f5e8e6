"""Connected components of a large edge list by alternating stars.

Every round keeps one oriented edge list (larger node to smaller) in the shared
folder.  The minimum of a node's neighbours is aggregated on its own (partial
sums before the shuffle) and joined back from a written table, so that a node
with very many neighbours is a skewed join that the adaptive planner splits.
Only two numbers a round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import stage


def _mark(edges: DataFrame) -> tuple:
    h = F.xxhash64("v", "u").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h)).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) to (node, root): every node that has an edge to
    another node, with the smallest node it can reach."""
    e = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(),
              "llm-edges")
    mark = _mark(e)
    while True:
        both = e.unionByName(e.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = stage(both.groupBy("v").agg(F.min("u").alias("m"))
                      .select(F.col("v").alias("node"), F.least("v", "m").alias("m")), "llm-least")
        large = (e.join(least, e.u == least.node).select("v", F.col("m").alias("u"))
                 .unionByName(least.where("m < node").select(F.col("node").alias("v"), F.col("m").alias("u"))))
        large = stage(large, "llm-large").distinct()
        lower = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (large.join(lower, "v").where("u > m").select(F.col("u").alias("v"), F.col("m").alias("u"))
                 .unionByName(lower.select("v", F.col("m").alias("u"))))
        e = stage(small.distinct(), "llm-edges")
        now = _mark(e)
        if now == mark:
            return e.select(F.col("v").alias("node"), F.col("u").alias("root"))
        mark = now
