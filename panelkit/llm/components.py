"""Connected components of a graph too large for one machine.

Edges are rewritten until every node points to the smallest node it can reach: in turn, all larger neighbours of a node
are hung onto its smallest one, then all smaller ones (large star and small star). Each round takes an aggregate and a
join, so a node of any degree is spread over tasks; the number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.sources.staging import stage


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """node and component for every node of ``edges`` (a, b: long), however directed, repeated or looping."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = stage(edges.filter("a != b").select(high.alias("u"), low.alias("v")).distinct(), "edges")
    state = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if seen == state:
            break
        state = seen
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "edges-least")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.distinct(), "edges-large")
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), "edges-least")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        now = stage(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
