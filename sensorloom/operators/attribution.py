"""Attribution of predictions to features by sampled permutations (ML13)."""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def permutation_attribution(df: DataFrame, id_cols: Sequence[str], features: Sequence[str], predict: Callable[[DataFrame], DataFrame],
                            background: Mapping[str, float] | Sequence[Mapping[str, float]], permutations: int = 4, seed: int = 0) -> DataFrame:
    """``id_cols, feature, contribution, std_error``: Shapley values against a sample of background points, sampled over feature orders.

    In each order the features of a row replace those of the order's background point one after the
    other, and a feature is credited with the change of the prediction; the
    credits are averaged over the orders, and ``std_error`` is that of the average (NULL for one order).
    The contributions of a row sum up to its prediction less the mean prediction of the background points used,
    whatever the number of orders.  ``predict`` adds ``prediction`` to a table of the features (an MLlib
    model's ``transform`` does) and keeps other columns.

    Orders and background are arrays of one entry an order: a feature is the row's own where its
    rank is below the point's step.  The plan thus has one expression a feature.  The points without any and
    with all of a row's features are the same in many orders and are scored once: the first on the
    driver's few points, the second once a row.  Ids must be unique; rows are gathered by partial sums."""
    rng = random.Random(seed)
    features, ids = list(features), list(id_cols)
    points = [background] if isinstance(background, Mapping) else list(background)
    orders = [rng.sample(range(len(features)), len(features)) for _ in range(permutations)]
    mine = [points[k % len(points)] for k in range(permutations)]
    last = len(features)
    rank = {f: F.array(*[F.lit(o.index(i)) for o in orders]) for i, f in enumerate(features)}
    base = {f: F.array(*[F.lit(float(p[f])) for p in mine]) for f in features}
    spark = df.sparkSession
    start = predict(spark.createDataFrame([tuple(float(p[f]) for f in features) for p in mine], ", ".join(f"`{f}` double" for f in features))
                    .withColumn("_k", F.monotonically_increasing_id())).select("_k", F.col("prediction").cast("double").alias("_y"))
    starts = F.array(*[F.lit(float(y)) for _, y in sorted(map(tuple, start.collect()))])  # a number an order

    # step last stands for the row itself, in order 0 only
    seats = F.transform(F.sequence(F.lit(0), F.lit(permutations * max(last - 1, 0))), lambda i: F.when(
        i == 0, F.struct(F.lit(0).alias("_k"), F.lit(last).alias("_s"))).otherwise(
        F.struct(((i - 1) / F.lit(max(last - 1, 1))).cast("int").alias("_k"), ((i - 1) % max(last - 1, 1) + 1).cast("int").alias("_s"))))
    rows = df.select(*ids, *features, F.explode(seats).alias("_p")).select(*ids, *features, "_p.*")
    rows = rows.select(*ids, "_k", "_s", *[F.when(rank[f][F.col("_k")] < F.col("_s"), F.col(f).cast("double")).otherwise(base[f][F.col("_k")]).alias(f) for f in features])
    scored = predict(rows).select(*ids, "_k", "_s", F.col("prediction").cast("double").alias("_y"))

    # a prediction at a step adds to the feature that came last, and takes from the one that comes next
    at = F.array(*[F.array(*[F.lit(i) for i in o]) for o in orders])

    def credit(k, place, y):
        return F.struct(k.alias("k"), at[k][place].alias("f"), y.alias("y"))
    k, s, y = F.col("_k"), F.col("_s"), F.col("_y")
    all_orders = F.sequence(F.lit(0), F.lit(permutations - 1))
    own = F.transform(all_orders, lambda j: credit(j, F.lit(last - 1), y))
    first = F.transform(all_orders, lambda j: credit(j, F.lit(0), -starts[j]))
    parts = F.when(s == last, F.concat(own, first)).otherwise(F.array(credit(k, s - 1, y), credit(k, F.least(s, F.lit(last - 1)), -y)))
    parts = scored.select(*ids, F.explode(parts).alias("c")).groupBy(*ids, "c.k", "c.f").agg(F.sum("c.y").alias("credit"))
    names = F.array(*[F.lit(f) for f in features])
    out = parts.groupBy(*ids, "f").agg(F.avg("credit").alias("contribution"), (F.stddev_samp("credit") / F.sqrt(F.lit(float(permutations)))).alias("std_error"))
    return out.select(*ids, names[F.col("f")].alias("feature"), "contribution", "std_error")
