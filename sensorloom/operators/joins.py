"""Joins on time (JOI1–JOI18).

* 1:1 merges on the timestamp with an optional uniqueness guard (JOI1).
* Time-shift self joins — the value ``freq`` later / earlier (JOI4).
* As-of backward join, built as validity intervals + a bucketed range join
  so no global ordering window ever runs on the large side (JOI7).
* Interval anti/semi joins for shutdowns and KS windows (FLT4, JOI17).

No side is hinted: adaptive execution broadcasts a side by its measured size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions.exprs import (
    MICROS_PER_SECOND, epoch_us, seconds, shift_time,
)

def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "table") -> None:
    """Raise if ``keys`` repeat in ``df`` (the reference's ``validate="1:1"``)."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"{what}: key {list(keys)} is not unique")


def merge_tables_on_timestamp(dfs: Sequence[DataFrame], ts_col: str = "ts",
                              validate: bool = False) -> DataFrame:
    """JOI1: fold of left joins on the timestamp, 1:1 enforced when ``validate``."""
    if validate:
        for i, d in enumerate(dfs):
            assert_unique(d, [ts_col], f"table {i}")
    return reduce(lambda a, b: a.join(b, ts_col, "left"), dfs)


def create_target_lags(df: DataFrame, targets: Sequence[str], freq: str | int,
                       ts_col: str = "ts") -> DataFrame:
    """JOI4: ``calc_p1_lag_t`` = value at ``ts + freq``, ``calc_m1_lag_t`` at ``ts − freq``.

    The shift is by time, not by row, so it is an equi join on the shifted
    key (hash-partitioned on ``ts``; no ordering window, no single task).
    """
    s = seconds(freq)
    raw = [t.split("lag_", 1)[1] if "lag_" in t else t for t in targets]
    fwd = df.select(shift_time(ts_col, -s).alias(ts_col),
                    *[F.col(t).alias(f"calc_p1_lag_{t}") for t in raw])
    back = df.select(shift_time(ts_col, s).alias(ts_col),
                     *[F.col(t).alias(f"calc_m1_lag_{t}") for t in raw])
    return df.join(fwd, ts_col, "left").join(back, ts_col, "left")


def select_data_clusters(data: DataFrame, labels: DataFrame, cluster: int,
                         ts_col: str = "ts", cluster_col: str = "cluster") -> DataFrame:
    """JOI5: rows of one operating regime (inner join on the timestamp)."""
    keep = labels.where(F.col(cluster_col) == F.lit(cluster)).select(ts_col)
    return data.join(keep, ts_col, "inner")


def attach_labels(data: DataFrame, labels: DataFrame, ts_col: str = "ts") -> DataFrame:
    """JOI6: left join of cluster labels."""
    return data.join(labels, ts_col, "left")


def keep_timestamps(data: DataFrame, stamps: DataFrame, ts_col: str = "ts") -> DataFrame:
    """JOI18: keep the listed timestamps (left semi join)."""
    return data.join(stamps.select(ts_col), ts_col, "left_semi")


# --------------------------------------------------------------------------
# as-of backward join
# --------------------------------------------------------------------------

def validity_intervals(ref: DataFrame, ref_ts: str, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys…, valid_from, valid_to)``: each reference stamp holds until the next.

    The ordering window runs on the reference side only (one row per event
    such as a relining campaign), partitioned by ``keys`` when given.
    """
    w = Window.partitionBy(*keys).orderBy("valid_from") if keys else Window.orderBy("valid_from")
    d = ref.select(*keys, F.col(ref_ts).alias("valid_from")).dropDuplicates([*keys, "valid_from"])
    return d.withColumn("valid_to", F.lead("valid_from").over(w))


def asof_backward(probe: DataFrame, ref: DataFrame, probe_ts: str, ref_ts: str,
                  keys: Sequence[str] = (), bucket_days: int = 30) -> DataFrame:
    """JOI7 core: attach ``valid_from`` = the latest ``ref_ts ≤ probe_ts``.

    Range join made equi: every interval is exploded into the coarse
    ``bucket_days`` buckets it overlaps, the probe is keyed by its own
    bucket, and the range predicate filters the candidate pairs.  Each probe
    row meets only the intervals of its bucket (usually one or two), so the
    join stays linear.  The last interval is open-ended: it is exploded up to
    the probe side's maximum bucket.  Probe rows before the first reference
    stamp get NULL (left join).
    """
    b = bucket_days * 86400 * MICROS_PER_SECOND
    iv = validity_intervals(ref, ref_ts, keys)
    pmax = probe.agg(F.max(epoch_us(probe_ts)).alias("m")).first()["m"]
    if pmax is None:
        return probe.withColumn("valid_from", F.lit(None).cast("timestamp_ntz"))
    lo_b = F.floor(epoch_us("valid_from") / F.lit(b))
    hi_b = F.floor(F.coalesce(epoch_us("valid_to"), F.lit(pmax)) / F.lit(b))
    iv = iv.select(*keys, "valid_from", "valid_to",
                   F.explode(F.sequence(lo_b, F.greatest(lo_b, hi_b))).alias("_bucket"))
    pr = probe.withColumn("_bucket", F.floor(epoch_us(probe_ts) / F.lit(b)))
    cond = [pr["_bucket"] == iv["_bucket"]] + [pr[k] == iv[k] for k in keys]
    cond += [pr[probe_ts] >= iv["valid_from"],
             iv["valid_to"].isNull() | (pr[probe_ts] < iv["valid_to"])]
    out = pr.join(iv, reduce(lambda a, c: a & c, cond), "left")
    return out.select(*[pr[c] for c in probe.columns], iv["valid_from"])


def days_since_last(probe: DataFrame, ref: DataFrame, probe_ts: str, ref_ts: str,
                    out_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """JOI7: whole days since the latest reference stamp ≤ ``probe_ts`` (NULL before the first)."""
    j = asof_backward(probe, ref, probe_ts, ref_ts, keys)
    days = F.floor((epoch_us(probe_ts) - epoch_us("valid_from"))
                   / F.lit(86400 * MICROS_PER_SECOND)).cast("long")
    return j.withColumn(out_col, days).drop("valid_from")


# --------------------------------------------------------------------------
# interval joins
# --------------------------------------------------------------------------

def exclude_intervals(df: DataFrame, intervals: DataFrame, ts_col: str = "ts",
                      start_col: str = "start_ts", end_col: str = "end_ts") -> DataFrame:
    """FLT2/FLT4: drop rows inside any closed ``[start, end]`` interval.

    Intervals are cut into days, so the anti join is an equi join on the day
    with the bounds as a further condition, whatever the number of intervals.
    """
    bad = intervals.where(F.col(end_col) <= F.col(start_col)).limit(1).count()
    if bad:
        raise ValueError("shutdown interval with end <= start")
    def day(c):
        return F.floor(epoch_us(c) / F.lit(86_400 * MICROS_PER_SECOND))
    iv = intervals.select(F.col(start_col).alias("_from"), F.col(end_col).alias("_to"),
                          F.explode(F.sequence(day(start_col), day(end_col))).alias("_day"))
    cond = (day(df[ts_col]) == F.col("_day")) & (df[ts_col] >= F.col("_from")) & (df[ts_col] <= F.col("_to"))
    return df.join(iv, cond, "left_anti")


def in_windows(df: DataFrame, windows: DataFrame, ts_col: str, start_col: str, end_col: str,
               step_s: int, window_cols: Sequence[str]) -> DataFrame:
    """JOI17: rows of ``df`` inside each ``[start, end]`` window, as an equi join.

    Windows are exploded into ``step_s`` buckets and joined on the bucket,
    then the exact range predicate filters.  Output keeps the window id
    columns, so one row may belong to several (overlapping) windows.
    """
    b = step_s * MICROS_PER_SECOND
    w = windows.select(*window_cols, start_col, end_col,
                       F.explode(F.sequence(F.floor(epoch_us(start_col) / F.lit(b)),
                                            F.floor(epoch_us(end_col) / F.lit(b)))).alias("_b"))
    d = df.withColumn("_b", F.floor(epoch_us(ts_col) / F.lit(b)))
    j = d.join(w, "_b").where((F.col(ts_col) >= F.col(start_col)) & (F.col(ts_col) <= F.col(end_col)))
    return j.drop("_b")
