"""Time-bin resampling (AGG1–AGG4, AGG17).

A bin label is an arithmetic expression on the timestamp, so resampling
is one ``groupBy(label)`` with a partial (map-side) aggregate: the shuffle
carries one row per (input partition, bin).  Empty bins are restored by a
left join from the bin grid, which is as small as the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.exprs import (
    MICROS_PER_SECOND, bin_left, bin_right, epoch_us, seconds,
)
from sensorloom.operators.grid import grid_between


def _value_cols(df: DataFrame, ts_col: str, cols: Sequence[str] | None) -> list[str]:
    return [c for c in (cols if cols is not None else df.columns) if c != ts_col]


def _bin_grid(df: DataFrame, ts_col: str, rule_s: int, offset_s: int, closed: str) -> DataFrame:
    """Every bin label between the first and the last non-empty bin."""
    r = rule_s * MICROS_PER_SECOND
    o = offset_s * MICROS_PER_SECOND
    t = epoch_us(ts_col) - F.lit(o)
    k = F.ceil(t / F.lit(r)) if closed == "right" else F.floor(t / F.lit(r))
    b = df.agg(F.min(k).alias("lo"), F.max(k).alias("hi")).first()
    if b["lo"] is None:
        return grid_between(df.sparkSession, 0, -1, rule_s, ts_col, pos=False)
    return grid_between(df.sparkSession, int(b["lo"]) * r + o, int(b["hi"]) * r + o,
                        rule_s, ts_col, pos=False)


def resample(df: DataFrame, rule: str | int, offset: str | int = 0, ts_col: str = "ts",
             cols: Sequence[str] | None = None, how: str = "mean",
             closed: str = "right", label: str | None = None,
             count_cols: Sequence[str] = (), count_prefix: str = "calc_count_",
             keep_empty: bool = True) -> DataFrame:
    """Resample a wide table into time bins.

    ``closed="right"`` gives pandas ``closed="right", label="right"``
    (AGG1); ``closed="left"`` gives the default left-closed, left-labelled
    bins (AGG3, AGG4, AGG17).  ``count_cols`` adds ``count(col)`` per bin
    in the same aggregate (AGG2).  With ``keep_empty`` empty bins are kept
    with NULL means and 0 counts, as pandas does.
    """
    rule_s, offset_s = seconds(rule), seconds(offset)
    label = label or closed
    if label != closed:
        raise ValueError("only label == closed is supported")
    values = _value_cols(df, ts_col, cols)
    lab = (bin_right if closed == "right" else bin_left)(ts_col, rule_s, offset_s)
    fn = {"mean": F.avg, "sum": F.sum, "max": F.max, "min": F.min, "count": F.count}[how]
    aggs = [fn(c).alias(c) for c in values]
    aggs += [F.count(c).alias(count_prefix + c) for c in count_cols]
    out = df.groupBy(lab.alias(ts_col)).agg(*aggs)
    if not keep_empty:
        return out
    grid = _bin_grid(df, ts_col, rule_s, offset_s, closed)
    out = grid.join(out, ts_col, "left")
    if count_cols or how == "count":
        fills = {count_prefix + c: 0 for c in count_cols}
        if how == "count":
            fills.update({c: 0 for c in values})
        out = out.fillna(fills)
    return out


def group_by_shift(df: DataFrame, rule: str = "2H", offset: str = "23H", ts_col: str = "ts",
                   cols: Sequence[str] | None = None,
                   count_cols: Sequence[str] = ()) -> DataFrame:
    """AGG1 (+AGG2 when ``count_cols``): shift means, right-closed and right-labelled."""
    return resample(df, rule, offset, ts_col, cols, "mean", "right", count_cols=count_cols)


def create_target_counts(df_raw: DataFrame, df_agg: DataFrame, targets: Sequence[str],
                         rule: str = "2H", offset: str = "23H", ts_col: str = "ts") -> DataFrame:
    """AGG2 + JOI3: non-NULL target counts per shift appended to ``df_agg``.

    A ``lag_`` prefix is stripped from target names first.  (When the means
    and counts come from the same table prefer ``group_by_shift(count_cols=…)``
    which needs no join.)
    """
    raw = [t.split("lag_", 1)[1] if "lag_" in t else t for t in targets]
    counts = resample(df_raw, rule, offset, ts_col, cols=[], how="mean", closed="right",
                      count_cols=raw)
    return df_agg.join(counts, ts_col, "left")


def data_group_per_hour(df: DataFrame, ts_col: str = "ts",
                        cols: Sequence[str] | None = None) -> DataFrame:
    """AGG3: hourly mean, left-closed, empty hours kept as NULL."""
    return resample(df, "1H", 0, ts_col, cols, "mean", "left")


def four_hour_mean(df: DataFrame, ts_col: str = "ts", cols: Sequence[str] | None = None,
                   base_hours: int = 23) -> DataFrame:
    """AGG4: 4-hour mean with base 23 — bins start at 03, 07, 11, 15, 19, 23."""
    return resample(df, "4H", f"{base_hours % 4}H", ts_col, cols, "mean", "left")


def calendar_resample(df: DataFrame, unit: str, how: str, ts_col: str = "ts",
                      cols: Sequence[str] | None = None) -> DataFrame:
    """AGG17: calendar bins with ``sum``/``max``/``mean``/``min``.

    ``unit="day"`` labels each day by its midnight; ``unit="month"`` labels a
    month by the midnight of its **last** day (pandas month-end ``"M"``).
    Calendar months are not fixed width, so this uses date functions
    instead of the epoch formula; they are time-zone free on TIMESTAMP_NTZ.
    """
    values = _value_cols(df, ts_col, cols)
    fn = {"mean": F.avg, "sum": F.sum, "max": F.max, "min": F.min}[how]
    day = F.to_date(F.col(ts_col))
    if unit == "day":
        lab = day
    elif unit == "month":
        lab = F.last_day(day)
    else:
        raise ValueError("unit must be 'day' or 'month'")
    lab = F.make_timestamp_ntz(F.year(lab), F.month(lab), F.dayofmonth(lab),
                               F.lit(0), F.lit(0), F.lit(0))
    return df.groupBy(lab.alias(ts_col)).agg(*[fn(c).alias(c) for c in values])
