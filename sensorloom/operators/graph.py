"""Connected components of an edge table (joins and aggregates only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.session import written


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """``node, root`` for every node of ``edges(u, v)``: the root is the least node it is connected to.

    Every node holds the least node it has heard of.  In a round the roots of an edge's two ends are joined,
    the greater root hangs on the least one it meets, and all pointers are followed one step further, so
    that long chains halve.  Each round is written; a hot root is reduced by partial aggregates."""
    links = written(edges.where("u <> v").select("u", "v").distinct(), "links")
    nodes = links.select(F.col("u").alias("node")).union(links.select("v")).distinct()
    at = written(nodes.select("node", F.col("node").alias("root")), "roots")
    for k in range(rounds):
        ends = links.join(at.select(F.col("node").alias("u"), F.col("root").alias("a")), "u")
        ends = ends.join(at.select(F.col("node").alias("v"), F.col("root").alias("b")), "v").where("a <> b")
        hung = ends.groupBy(F.greatest("a", "b").alias("root")).agg(F.min(F.least("a", "b")).alias("up"))
        hung = written(hung, f"hung-{k}")
        if hung.isEmpty():
            return at
        # a root may hang on a root that hangs itself: follow until the pointers of this round are flat
        while True:
            on = hung.select(F.col("root").alias("up"), F.col("up").alias("next"))
            flat = written(hung.join(on, "up", "left").select("root", F.coalesce("next", "up").alias("up"), F.col("next").isNotNull().alias("moved")), "flat")
            hung = flat.select("root", "up")
            if flat.where("moved").isEmpty():
                break
        at = written(at.join(hung, "root", "left").select("node", F.coalesce("up", "root").alias("root")), f"roots-{k}")
    raise RuntimeError(f"components have not settled after {rounds} rounds")
