"""Exact quantiles and running counts without one buffer per key.

``percentile`` keeps every distinct value of a key in one aggregate buffer.
Here values are first counted (a partial aggregate), the counts are sorted by
range over the cluster and written, and each sorted part adds up its own
counts; a table of one row per key and part then tells where each part starts.
A key with a third of all rows is spread over as many parts as its values need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.session import written


def running_counts(values: DataFrame, keys: Sequence[str], value: str, counts: Sequence[str]) -> DataFrame:
    """``values`` (one row per key and value) with ``cum_<c>`` and ``all_<c>`` for each count column:
    its sum up to and with this value, and over the key.  Keys must not be NULL."""
    spark = values.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # the parts must be the ranges themselves, so the sorted rows are written with their part's number
    parts = values.repartitionByRange(n, *keys, value).withColumn("_part", F.spark_partition_id())
    parts = written(parts, "sorted")
    part_key = [*keys, "_part"]
    sums = parts.groupBy(*part_key).agg(*[F.sum(c).alias(f"_s_{c}") for c in counts])
    # one row per key and part
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    starts = sums.select(*part_key, *[F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).alias(f"_b_{c}") for c in counts],
                         *[F.sum(f"_s_{c}").over(whole).alias(f"all_{c}") for c in counts])
    run = Window.partitionBy(*part_key).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    own = parts.withColumns({f"_r_{c}": F.sum(c).over(run) for c in counts})
    out = own.join(starts, part_key)
    return out.select(*values.columns, *[(F.col(f"_r_{c}") + F.col(f"_b_{c}")).alias(f"cum_{c}") for c in counts],
                      *[f"all_{c}" for c in counts])


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float]) -> DataFrame:
    """``keys, q0, q1, …``: linear-interpolated quantiles per key, NULL values left out; keys without values have no row."""
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    counted = running_counts(rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("n")), keys, "_v", ["n"])
    aggs = []
    for i, q in enumerate(qs):
        rank = F.lit(float(q)) * (F.col("all_n") - 1)
        for name, r in (("l", F.floor(rank)), ("h", F.ceil(rank))):
            here = (r < F.col("cum_n")) & (r >= F.col("cum_n") - F.col("n"))
            aggs.append(F.max(F.when(here, F.col("_v"))).alias(f"_{name}{i}"))
        aggs.append(F.max(rank - F.floor(rank)).alias(f"_f{i}"))
    got = counted.groupBy(*keys).agg(*aggs)
    return got.select(*keys, *[(F.col(f"_l{i}") * (1 - F.col(f"_f{i}")) + F.col(f"_h{i}") * F.col(f"_f{i}")).alias(f"q{i}")
                               for i in range(len(qs))])


def column_quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float]) -> dict[str, list[float | None]]:
    """The quantiles of whole columns, as numbers: one row per column is all that reaches the driver."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in cols])).alias("x")).select("x.c", "x.v")
    got = {r.c: list(r[1:]) for r in exact_quantiles(long, ["c"], "v", qs).collect()}
    return {c: got.get(c, [None] * len(qs)) for c in cols}
