"""Connected components over an edge table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.session import written


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``; root is the smallest node of its component.

    Alternating large-star and small-star steps: each round hangs neighbours
    on the smallest node seen, so the number of rounds grows with the logarithm
    of the component size.  Every round is written to the shared folder, which
    keeps the plan short and survives lost executors.  Hot nodes are reduced by
    partial aggregates, and the joins back are plain equi-joins that adaptive
    execution splits.  Loops, repeated and null edges are ignored; an empty
    table gives an empty table.  Raises if it has not settled after ``max_rounds``.
    """
    now = written(_descending(edges), "edges")
    before = _signature(now)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small")
        after = _signature(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components have not settled after {max_rounds} rounds")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _descending(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _signature(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(h.cast("decimal(38,0)"))).first())
