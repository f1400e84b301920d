"""Connected components by alternating large and small stars, all in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillflow.llm.common import staged


def _written(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """Distinct edges as a written table, and their count and order-free checksum from that write."""
    seen = Observation()
    checksum = F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")).alias("checksum")
    table = staged(edges.distinct().observe(seen, F.count(F.lit(1)).alias("edges"), checksum))
    found = seen.get
    return table, (found.get("edges", 0), found.get("checksum") or 0)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """For undirected edges (a, b): one row (node, component) per node that is not the least of its
    component, the component being the least node reachable.

    Each round is written, so no plan and no recomputation grows with the rounds. The least
    neighbours are written before they are joined: both sides of that join are then plain shuffles,
    and Spark splits the rows of a hub over many tasks. No edge leaves the executors; the driver
    sees a count and a checksum per round.
    """
    pair = edges.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
    now, state = _written(pair.where("high <> low"))
    while state[0]:
        both = now.union(now.select(F.col("low").alias("high"), F.col("high").alias("low")))
        least = staged(both.groupBy(F.col("high").alias("node")).agg(F.least("high", F.min("low")).alias("least")))
        upward = both.select(F.col("high").alias("node"), F.col("low").alias("high")).where("high > node")
        large = upward.join(least, "node").select("high", F.col("least").alias("low")).distinct()
        # After the large stars a node has few lesser neighbours: the hub is one of them.
        own = large.groupBy("high").agg(F.min("low").alias("least"))
        small = large.join(own, "high").select(F.col("low").alias("high"), F.col("least").alias("low"))
        after, after_state = _written(small.where("high <> low").union(own.select("high", F.col("least").alias("low"))))
        now, over, state = after, after_state == state, after_state
        if over:
            break
    return now.select(F.col("high").alias("node"), F.col("low").alias("component"))
