"""Density clustering with noise (CLU2).

A point with at least ``min_samples`` points within ``radius`` (itself included) is a core point; core
points within the radius of each other are one cluster; another point within the radius of a core point
belongs to the nearest one's cluster; the rest is noise.

Points are dealt to grid cells whose diagonal is the radius, so all points of a cell are neighbours of each
other.  That settles crowded places without comparing points: in a cell of ``min_samples`` points all are
core, and the core points of a cell are one node of the graph.  Points are compared in pairs of cells that
lie near enough, and only

* to count the neighbours of points in cells of fewer than ``min_samples`` points,
* to connect two cells whose extreme points do not connect them, and that other cells do not connect.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.operators.graph import components
from sensorloom.operators.windows import dense_index
from sensorloom.session import written


def _square(a: Sequence[str], b: Sequence[str]) -> Column:
    return sum(((F.col(x) - F.col(y)) ** 2 for x, y in zip(a, b)), F.lit(0.0))


def _gap(d: int, far: bool) -> Column:
    """Squared distance of the boxes (alo, ahi) and (blo, bhi): the least, or the greatest."""
    out = F.lit(0.0)
    for i in range(d):
        if far:
            g = F.greatest(F.col(f"ahi{i}") - F.col(f"blo{i}"), F.col(f"bhi{i}") - F.col(f"alo{i}"))
        else:
            g = F.greatest(F.lit(0.0), F.col(f"alo{i}") - F.col(f"bhi{i}"), F.col(f"blo{i}") - F.col(f"ahi{i}"))
        out = out + g ** 2
    return out


def _near_cells(boxes: DataFrame, d: int, radius: float, r2: Column) -> DataFrame:
    """``a, b`` (both ways) of cells whose boxes ``(cell, lo*, hi*)`` come within the radius: joined on blocks of a radius' width."""
    sides = [f"{k}{i}" for k in ("lo", "hi") for i in range(d)]
    blocks = [f"_b{i}" for i in range(d)]
    dealt = boxes.select("cell", *sides, *[F.floor(F.col(f"lo{i}") / radius).cast("long").alias(c) for i, c in enumerate(blocks)])
    a = dealt.select(F.col("cell").alias("a"), *[F.col(c).alias(f"a{c}") for c in sides], *blocks)
    for c in blocks:  # a box is narrower than a block, so its neighbours start at most two blocks away
        a = a.withColumn(c, F.explode(F.array(*[F.col(c) + k for k in (-2, -1, 0, 1, 2)])))
    b = dealt.select(F.col("cell").alias("b"), *[F.col(c).alias(f"b{c}") for c in sides], *blocks)
    return a.join(b, blocks).where((F.col("a") != F.col("b")) & (_gap(d, False) <= r2)).drop(*blocks)


def density_labels(df: DataFrame, cols: Sequence[str], radius: float, min_samples: int, min_cluster_size: int = 1,
                   label_col: str = "cluster") -> DataFrame:
    """``df`` with integer labels: 0 for noise, clusters 1, 2, … by falling size, of equal ones by the least point.

    Clusters of fewer than ``min_cluster_size`` rows are noise.  Rows with a NULL or NaN among ``cols`` are noise.
    Equal rows are one point with a weight.  A point outside all cores' cells joins the nearest core point's cluster,
    of equally near ones the smaller point's.  At most six columns (blocks are joined with 5 ** columns neighbours)."""
    return labels_by_setting(df, cols, radius, [(min_samples, min_cluster_size)], label_col).drop("setting")


def labels_by_setting(df: DataFrame, cols: Sequence[str], radius: float, settings: Sequence[tuple[int, int]], label_col: str = "cluster") -> DataFrame:
    """:func:`density_labels` of several ``(min_samples, min_cluster_size)`` at once: the rows of ``df`` with ``setting`` (0, 1, …) and label.

    Cells, neighbours and their numbers are found once; all settings go through each later step together."""
    d = len(cols)
    if not 1 <= d <= 6:
        raise ValueError("density labels take one to six columns")
    side, r2 = radius / math.sqrt(d) * (1 - 1e-9), F.lit(float(radius) ** 2)
    xs = [f"x{i}" for i in range(d)]
    others = [f"o{x}" for x in xs]
    sides = [f"{k}{i}" for k in ("lo", "hi") for i in range(d)]
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("setting"), F.lit(int(s)).alias("samples")) for k, (s, _) in enumerate(settings)]))
    smallest = F.array(*[F.lit(int(m)) for _, m in settings])

    def with_settings(t: DataFrame) -> DataFrame:
        return t.withColumn("_e", each).select("_e.setting", "_e.samples", *t.columns)

    def named(t: DataFrame, cell: str, prefix: str, *more: str) -> DataFrame:
        return t.select(*(["setting"] if "setting" in t.columns else []), F.col("cell").alias(cell), *[F.col(c).alias(prefix + c) for c in more])
    values = {x: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c, x in zip(cols, xs)}
    points = df.select(*[v.alias(x) for x, v in values.items()]).na.drop().groupBy(*xs).agg(F.count(F.lit(1)).alias("n"))
    points = written(points.select(F.array(*[F.floor(F.col(x) / side).cast("long") for x in xs]).alias("cell"), *xs, "n"), "points")
    extremes = [f(x).alias(f"{k}{x[1:]}") for x in xs for k, f in (("lo", F.min), ("hi", F.max))]
    cells = written(points.groupBy("cell").agg(F.sum("n").alias("m"), *extremes), "cells")
    near = written(_near_cells(cells, d, float(radius), r2).select("a", "b"), "near")

    # core points: all of a cell of enough points; the points of other cells are counted
    most = max(s for s, _ in settings)
    thin = points.join(cells.where(F.col("m") < most).select("cell", "m"), "cell")
    other = points.select(F.col("cell").alias("b"), *[F.col(x).alias(o) for x, o in zip(xs, others)], F.col("n").alias("on"))
    around = thin.join(near.withColumnRenamed("a", "cell"), "cell").join(other, "b").where(_square(xs, others) <= r2)
    around = around.groupBy(*xs).agg(F.sum("on").alias("more"))
    thin = thin.join(around, xs, "left").select("cell", *xs, "n", "m", (F.col("m") + F.coalesce("more", F.lit(0))).alias("have"))
    full = with_settings(points.join(cells.select("cell", "m"), "cell")).where("m >= samples").select("setting", "cell", *xs)
    core = full.unionByName(with_settings(thin).where("m < samples and have >= samples").select("setting", "cell", *xs))
    core = written(core, "core")

    # cells of core points that connect: by their extreme points first
    places = core.groupBy("setting", "cell").agg(
        *extremes, *[f(F.struct(*xs), x).alias(f"{k}_{x}") for x in xs for k, f in (("low", F.min_by), ("top", F.max_by))])
    places = written(places, "places")
    witnesses = places.select("setting", "cell", F.explode(F.array_distinct(F.array(*[F.col(f"{k}_{x}") for x in xs for k in ("low", "top")]))).alias("w"))
    witnesses = witnesses.select("setting", "cell", *[F.col(f"w.{x}").alias(x) for x in xs])
    pairs = near.where("a < b").join(named(places, "a", "a", *sides), "a").join(named(places, "b", "b", *sides), ["setting", "b"])
    pairs = written(pairs.where(_gap(d, False) <= r2).select("setting", "a", "b", (_gap(d, True) <= r2).alias("sure")), "pairs")

    def met(of: DataFrame, ours: DataFrame) -> DataFrame:
        both = of.join(named(ours, "a", "", *xs), ["setting", "a"]).join(named(ours, "b", "o", *xs), ["setting", "b"])
        return both.where(_square(xs, others) <= r2).select("setting", "a", "b").distinct()

    def rooted(links: DataFrame) -> DataFrame:
        node = {k: F.struct("setting", F.col(k).alias("cell")).alias(n) for k, n in (("a", "u"), ("b", "v"))}
        roots = components(links.select(*node.values()))
        roots = roots.select("node.setting", "node.cell", F.col("root.cell").alias("root"))
        all_cells = places.select("setting", "cell").join(roots, ["setting", "cell"], "left")
        return written(all_cells.select("setting", "cell", F.coalesce("root", "cell").alias("root")), "cell-roots")
    links = pairs.where("sure").select("setting", "a", "b").unionByName(met(pairs.where("not sure").drop("sure"), witnesses))
    links = written(links, "connected")
    roots = rooted(links)
    # pairs of cells that are not in one component yet are compared point by point
    apart = pairs.where("not sure").join(named(roots, "a", "a", "root"), ["setting", "a"]).join(named(roots, "b", "b", "root"), ["setting", "b"])
    rest = written(met(apart.where("aroot <> broot").select("setting", "a", "b"), core), "rest")
    if not rest.isEmpty():
        roots = rooted(links.unionByName(rest))

    # the points that are no core look for the nearest one around them
    own = with_settings(points).drop("samples").join(core.withColumn("_c", F.lit(True)), ["setting", "cell", *xs], "left")
    own = written(own.join(roots, ["setting", "cell"], "left").select("setting", "cell", *xs, "n", F.col("_c").isNotNull().alias("core"), "root"), "own")
    reach = near.unionByName(cells.select(F.col("cell").alias("a"), F.col("cell").alias("b"))).withColumnRenamed("a", "cell")
    cores = named(core.join(roots, ["setting", "cell"]), "b", "o", *xs, "root")
    seen = own.where("not core").drop("root").join(reach, "cell").join(cores, ["setting", "b"]).where(_square(xs, others) <= r2)
    nearest = seen.groupBy("setting", *xs, "n").agg(F.min(F.struct(_square(xs, others).alias("far"), *others, F.col("oroot").alias("root"))).alias("k"))
    labelled = own.where("core").select("setting", *xs, "n", "root").unionByName(nearest.select("setting", *xs, "n", F.col("k.root").alias("root")))
    labelled = written(labelled, "labelled")
    sizes = labelled.groupBy("setting", "root").agg(F.sum("n").alias("rows"), F.min(F.struct(*xs)).alias("least"))
    sizes = sizes.where(F.col("rows") >= smallest[F.col("setting")])
    order = sizes.select("setting", "root", F.struct((-F.col("rows")).alias("r"), "least").alias("order"))
    numbers = dense_index(order, ["setting"], "order", "_k").select("setting", "root", (F.col("_k") + 1).cast("int").alias(label_col))
    final = labelled.join(numbers, ["setting", "root"]).select("setting", *xs, label_col)
    keyed = with_settings(df.drop(label_col).withColumns(values)).drop("samples")
    out = keyed.join(final, ["setting", *xs], "left").withColumn(label_col, F.coalesce(label_col, F.lit(0)))
    return out.select("setting", *[c for c in df.columns if c != label_col], label_col)
