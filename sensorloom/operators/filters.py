"""Row filters and de-duplication (FLT1–FLT18).

Predicates are plain Column expressions so Catalyst pushes the simple ones
(time ranges, thresholds) into the Parquet scan.  ``now()`` is never read:
time-relative filters take an explicit ``as_of`` so reruns are repeatable.
De-duplication is a partial aggregate (``max_by``/``min_by`` of the row),
which stays balanced even when one key holds a large share of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.exprs import all_of, any_of, cut, open_interval
from sensorloom.operators.quantiles import column_quantiles


def filter_date_range(df: DataFrame, as_of: datetime, months: int, ts_col: str = "ts",
                      end_date: datetime | None = None) -> DataFrame:
    """FLT1: ``ts ≥ as_of − 30·months days`` and optionally ``ts ≤ end_date``."""
    start = F.lit(as_of) - F.expr(f"INTERVAL {int(months) * 30} DAYS")
    cond = F.col(ts_col) >= start.cast("timestamp_ntz")
    if end_date is not None:
        cond = cond & (F.col(ts_col) <= F.lit(end_date).cast("timestamp_ntz"))
    return df.where(cond)


def exclude_dates(df: DataFrame, intervals: Sequence[tuple], ts_col: str = "ts") -> DataFrame:
    """FLT2 (ignore_dates): drop rows in any closed ``[d1, d2]`` parameter interval."""
    preds = [F.col(ts_col).between(F.lit(a).cast("timestamp_ntz"), F.lit(b).cast("timestamp_ntz"))
             for a, b in intervals]
    return df.where(~any_of(preds))


def remove_shut_downs(df: DataFrame, intervals: Sequence[tuple], ts_col: str = "ts") -> DataFrame:
    """FLT4: keep rows strictly outside every ``[d1, d2]``; error when ``d2 ≤ d1``."""
    for a, b in intervals:
        if b <= a:
            raise RuntimeError("each shutdown interval needs d1 < d2")
    return exclude_dates(df, intervals, ts_col)


def filter_target(df: DataFrame, target: str, current=None, lag_p1=None, count=None,
                  start=None, end=None, ts_col: str = "ts") -> DataFrame:
    """FLT3: open interval on the target, open interval on its next-shift
    value, ``calc_count_ > count``, closed date interval — each optional."""
    t = target.split("lag_", 1)[1] if "lag_" in target else target
    preds = []
    if current is not None:
        preds.append(open_interval(t, current[0], current[1]))
    if lag_p1 is not None:
        preds.append(open_interval(f"calc_p1_lag_{t}", lag_p1[0], lag_p1[1]))
    if count is not None:
        preds.append(F.coalesce(F.col(f"calc_count_{t}") > F.lit(count), F.lit(False)))
    if start is not None and end is not None:
        preds.append(F.col(ts_col).between(F.lit(start).cast("timestamp_ntz"),
                                           F.lit(end).cast("timestamp_ntz")))
    return df.where(all_of(preds))


def threshold_filter(df: DataFrame, col: str, limit: float, below: bool = True) -> DataFrame:
    """FLT5: ``col < limit`` (or ``>``) — e.g. the water-crisis subset."""
    return df.where(F.col(col) < limit if below else F.col(col) > limit)


def filter_timestamp_optimization(df: DataFrame, start=None, end=None, mode: str = "end",
                                  n: int = 1, stamps: Sequence[datetime] | None = None,
                                  ts_col: str = "ts") -> DataFrame:
    """FLT6 + LIM1 + JOI18: inclusive time slice, then the first / last ``n`` rows
    (a top-n by time — ``TakeOrderedAndProject``) or an explicit stamp list."""
    d = df
    if start is not None:
        d = d.where(F.col(ts_col) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        d = d.where(F.col(ts_col) <= F.lit(end).cast("timestamp_ntz"))
    if mode == "beginning":
        return d.orderBy(F.col(ts_col).asc()).limit(n)
    if mode == "end":
        return d.orderBy(F.col(ts_col).desc()).limit(n)
    if mode == "list":
        lst = d.sparkSession.createDataFrame([(s,) for s in stamps or []], f"{ts_col} timestamp_ntz")
        out = d.join(lst, ts_col, "left_semi")
        if out.limit(1).count() == 0:
            raise ValueError("none of the listed timestamps is in the data")
        return out
    raise ValueError("mode must be beginning, end or list")


def stable_conditions(df: DataFrame, conditions: Mapping[str, Sequence]) -> DataFrame:
    """FLT7: AND of open intervals ``lo < col < hi`` per column."""
    return df.where(all_of(open_interval(c, lo, hi) for c, (lo, hi) in conditions.items()))


def dedupe(df: DataFrame, keys: Sequence[str], order_col: str, keep: str = "last") -> DataFrame:
    """FLT8 (keep last) / FLT9 (keep first) by ingest order ``order_col``.

    ``max_by``/``min_by`` of the whole row per key: a partial aggregate, so a
    hot key is pre-reduced on every partition before the shuffle.
    """
    others = [c for c in df.columns if c not in keys]
    pick = F.max_by if keep == "last" else F.min_by
    agg = df.groupBy(*keys).agg(pick(F.struct(*others), F.col(order_col)).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def distinct_rows(df: DataFrame) -> DataFrame:
    """FLT10: full-row distinct."""
    return df.dropDuplicates()


def envelope_filter(df: DataFrame, ranges: Mapping[str, Sequence]) -> DataFrame:
    """FLT12: AND of closed range predicates (NULL fails), then ±inf → NULL."""
    preds = [cut(c, lo, hi).isNotNull() for c, (lo, hi) in ranges.items()]
    kept = df.where(all_of(preds))
    return kept.withColumns({c: F.when(F.abs(F.col(c)) != float("inf"), F.col(c))
                             for c, t in df.dtypes if t in ("double", "float")})


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """FLT13: drop rows with a NULL in any of ``subset``."""
    return df.na.drop(subset=list(subset))


def above_own_quantile(df: DataFrame, col: str, q: float = 0.1) -> DataFrame:
    """FLT14: keep rows whose ``col`` exceeds its own ``q`` quantile (train only).

    The exact quantile is one number, read once and used as a literal.
    """
    (p,) = column_quantiles(df, [col], [q])[col]
    return df.where(F.col(col) > F.lit(p)) if p is not None else df.limit(0)


def two_date_ranges(df: DataFrame, r1: tuple, r2: tuple, ts_col: str = "ts") -> DataFrame:
    """FLT15: keep rows in either of two closed date ranges."""
    def rng(r):
        return F.col(ts_col).between(F.lit(r[0]).cast("timestamp_ntz"), F.lit(r[1]).cast("timestamp_ntz"))
    return df.where(rng(r1) | rng(r2))


def all_flags_on(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """FLT18a: rows where every on/off flag is 1."""
    return df.where(all_of(F.coalesce(F.col(f) == 1, F.lit(False)) for f in flags))


def any_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FLT18b: rows where any of ``cols`` is NULL."""
    return df.where(any_of(F.col(c).isNull() for c in cols))
