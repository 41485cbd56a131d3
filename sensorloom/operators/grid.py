"""Regular time grids (AGG5), grid joins (JOI2) and dense positions.

A grid is generated with ``spark.range`` — distributed over many
partitions — from two scalar bounds computed by one aggregate job.  Only
those two scalars reach the driver; the grid rows never do.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.exprs import MICROS_PER_SECOND, epoch_us, from_epoch_us, seconds


def _bounds_us(dfs: Sequence[DataFrame], ts_col: str) -> tuple[int | None, int | None]:
    """``(min, max)`` epoch microseconds over the union of ``dfs`` (one job)."""
    parts = [df.select(epoch_us(ts_col).alias("t")) for df in dfs]
    union = reduce(lambda a, b: a.unionAll(b), parts)
    row = union.agg(F.min("t").alias("lo"), F.max("t").alias("hi")).first()
    return row["lo"], row["hi"]


def grid_between(spark, lo_us: int, hi_us: int, step_s: int, ts_col: str = "ts",
                 pos: bool = True) -> DataFrame:
    """Grid ``lo, lo+step, …, ≤ hi`` as ``(ts[, pos])``; empty when ``hi < lo``."""
    step = step_s * MICROS_PER_SECOND
    n = 0 if hi_us < lo_us else (hi_us - lo_us) // step + 1
    parts = max(1, min(spark.sparkContext.defaultParallelism, n // 100_000 + 1))
    g = spark.range(0, n, 1, numPartitions=parts)
    cols = [from_epoch_us(F.lit(lo_us) + F.col("id") * F.lit(step)).alias(ts_col)]
    if pos:
        cols.append(F.col("id").alias("pos"))
    return g.select(*cols)


def create_time_grid(dfs: Sequence[DataFrame], freq: str | int, ts_col: str = "ts",
                     offset_start: str | int | None = None,
                     offset_end: str | int | None = None) -> DataFrame:
    """AGG5: grid from ``ceil(min + offset_start)`` to ``floor(max - offset_end)``.

    Bounds are taken over the union of every input table.
    """
    spark = dfs[0].sparkSession
    step = seconds(freq) * MICROS_PER_SECOND
    lo, hi = _bounds_us(dfs, ts_col)
    if lo is None:
        return grid_between(spark, 0, -1, seconds(freq), ts_col, pos=False)
    if offset_start:
        lo += seconds(offset_start) * MICROS_PER_SECOND
    if offset_end:
        hi -= seconds(offset_end) * MICROS_PER_SECOND
    lo = -(-lo // step) * step   # ceil to step
    hi = (hi // step) * step     # floor to step
    return grid_between(spark, lo, hi, seconds(freq), ts_col, pos=False)


def merge_to_grid(grid: DataFrame, *dfs: DataFrame, ts_col: str = "ts",
                  validate: bool = False) -> DataFrame:
    """JOI2: left-join tables to the grid after full-row de-duplication (FLT10).

    With ``validate=True`` a duplicate timestamp left after de-duplication
    raises, which is the reference's "row count changed" guard (one cheap
    aggregate job per table).
    """
    out = grid.dropDuplicates([ts_col]) if validate else grid
    for i, df in enumerate(dfs):
        d = df.dropDuplicates()
        if validate:
            dup = d.groupBy(ts_col).count().where(F.col("count") > 1).limit(1).count()
            if dup:
                raise RuntimeError(
                    f"Merging dataframe {i + 1} would change the number of grid rows: "
                    "duplicate timestamps")
        out = out.join(d, ts_col, "left")
    return out


def complete_grid(df: DataFrame, ts_col: str, step_s: int) -> DataFrame:
    """Left-join ``df`` to the full grid between its own first and last stamp.

    Adds ``pos`` — the dense grid index — which positional windows order by.
    """
    lo, hi = _bounds_us([df], ts_col)
    spark = df.sparkSession
    if lo is None:
        return df.withColumn("pos", F.lit(None).cast("long"))
    g = grid_between(spark, lo, hi, step_s, ts_col, pos=True)
    return g.join(df, ts_col, "left")


def grid_position(ts_col: str, t0_us: int, step_s: int):
    """Dense index of a timestamp on a grid starting at ``t0`` (no shuffle)."""
    return ((epoch_us(ts_col) - F.lit(t0_us)) / F.lit(step_s * MICROS_PER_SECOND)).cast("long")
