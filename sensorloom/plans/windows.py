"""Registered queries: positional windows, fills, NULL runs, EWM."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.operators import windows as W
from sensorloom.plans.common import SQL_TEN_LONG, finish, register, sql_r
from sensorloom.sources import fixtures as FX

# Bucket size used by the registered queries: small enough that the sf0.01
# series (4,320 ten-minute slots per tag) spans several buckets, so halos
# and carries are exercised by the oracle check.
BUCKET = 1024
KEYS = ["tag"]
DIFFS = [1, 6, 12, 24, 48]


def _ten_long(spark, sf_dir):
    return FX.ten_minute_grid_long(spark, sf_dir)


# ---------------------------------------------------------------- lags/diffs
_DIFF_SQL = ", ".join(f"{sql_r(f'value - lag(value, {k}) OVER w')} AS diff_{k}" for k in DIFFS)


@register("win_lag_diff", f"""
WITH {SQL_TEN_LONG}
SELECT tag, ts, {sql_r('value')} AS value,
       {sql_r('lag(value, 1) OVER w')} AS calc_m1_lag_value,
       {sql_r('lead(value, 1) OVER w')} AS calc_p1_lag_value,
       {_DIFF_SQL},
       {sql_r('lag(value, 1) OVER w - lag(value, 2) OVER w')} AS lag1_minus_lag2
FROM ten_long
WINDOW w AS (PARTITION BY tag ORDER BY pos)
""")
def win_lag_diff(spark, sf_dir):
    """WIN1, WIN2, WIN9 on the 10-minute grid, per tag, via halo buckets."""
    def build(w):
        cols = {"calc_m1_lag_value": W.lag_expr("value", 1, w),
                "calc_p1_lag_value": W.lag_expr("value", -1, w)}
        cols.update({f"diff_{k}": W.diff_expr("value", k, w) for k in DIFFS})
        cols["lag1_minus_lag2"] = F.lag("value", 1).over(w) - F.lag("value", 2).over(w)
        return cols
    out = W.positional(_ten_long(spark, sf_dir), KEYS, "pos", build, back=48, fwd=1,
                       bucket_rows=BUCKET)
    return finish(out.drop("pos"))


# ------------------------------------------------------------------- rolling
@register("win_rolling", f"""
WITH {SQL_TEN_LONG},
r AS (
  SELECT tag, ts, pos, value,
    CASE WHEN count(value) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) = 6
         THEN avg(value) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) END AS roll_6,
    CASE WHEN count(value) OVER (w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) = 12
         THEN avg(value) OVER (w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) END AS roll_12,
    CASE WHEN count(value) OVER (w ROWS BETWEEN 35 PRECEDING AND CURRENT ROW) = 36
         THEN avg(value) OVER (w ROWS BETWEEN 35 PRECEDING AND CURRENT ROW) END AS roll_36,
    CASE WHEN count(value) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 3
         THEN max(value) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
            = min(value) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) END AS flat_3
  FROM ten_long WINDOW w AS (PARTITION BY tag ORDER BY pos))
SELECT tag, ts, {sql_r('roll_6')} AS roll_6, {sql_r('roll_12')} AS roll_12,
       {sql_r('roll_36')} AS roll_36, flat_3,
       {sql_r('lag(roll_12, 6) OVER (PARTITION BY tag ORDER BY pos)')} AS roll_12_dead_6,
       {sql_r('(roll_6 + roll_36) / 2')} AS roll_mix
FROM r
""")
def win_rolling(spark, sf_dir):
    """WIN3 full-window rolling means, WIN4 flatline, WIN7 rolling→lag, WIN8 mixes."""
    def build(w):
        return {"roll_6": W.rolling_full_mean("value", 6, w),
                "roll_12": W.rolling_full_mean("value", 12, w),
                "roll_36": W.rolling_full_mean("value", 36, w),
                "flat_3": W.flatline_expr("value", 3, w)}
    r = W.positional(_ten_long(spark, sf_dir), KEYS, "pos", build, back=35, bucket_rows=BUCKET)
    r = W.positional(r, KEYS, "pos", lambda w: {"roll_12_dead_6": F.lag("roll_12", 6).over(w)},
                     back=6, bucket_rows=BUCKET)
    out = r.select("tag", "ts", "roll_6", "roll_12", "roll_36", "flat_3", "roll_12_dead_6",
                   ((F.col("roll_6") + F.col("roll_36")) / 2).alias("roll_mix"))
    return finish(out)


# ------------------------------------------------------------------- fills
@register("win_fill", f"""
WITH {SQL_TEN_LONG}
SELECT tag, ts,
  {sql_r('coalesce(value, lag(value, 1) OVER w, lead(value, 1) OVER w, lead(value, 2) OVER w)')}
      AS fill_limited,
  {sql_r('last_value(value IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')}
      AS fill_pad
FROM ten_long WINDOW w AS (PARTITION BY tag ORDER BY pos)
""")
def win_fill(spark, sf_dir):
    """CLN8 limited ffill(1)+bfill(2) (halo) and CLN9 unlimited pad (carry scan)."""
    d = _ten_long(spark, sf_dir)
    lim = W.positional(d, KEYS, "pos", lambda w: {"fill_limited": W.limited_fill("value", w)},
                       back=1, fwd=2, bucket_rows=BUCKET)
    pad = W.ffill(lim.withColumn("fill_pad", F.col("value")), KEYS, "pos", ["fill_pad"], BUCKET)
    return finish(pad.select("tag", "ts", "fill_limited", "fill_pad"))


# ------------------------------------------------------------------- EWM
HALFLIFE = 6.0
_D = 0.5 ** (1.0 / HALFLIFE)


@register("win_ewm", f"""
WITH {SQL_TEN_LONG},
e AS (
  SELECT tag, ts, pos,
    sum(CASE WHEN value IS NOT NULL THEN value * pow({_D!r}, -pos) END)
        OVER (PARTITION BY tag ORDER BY pos) AS n,
    sum(CASE WHEN value IS NOT NULL THEN pow({_D!r}, -pos) END)
        OVER (PARTITION BY tag ORDER BY pos) AS d
  FROM ten_long)
SELECT tag, ts, {sql_r('n / nullif(d, 0)')} AS ewm_value
FROM e
""")
def win_ewm(spark, sf_dir):
    """WIN5: EWM (half-life 6 rows, adjust=True, NULLs keep position) per tag."""
    out = W.ewm_mean(_ten_long(spark, sf_dir), KEYS, "pos", "value", HALFLIFE, "ewm_value",
                     bucket_rows=BUCKET)
    return finish(out.select("tag", "ts", "ewm_value"))


@register("win_lag_ewm_lag", f"""
WITH {SQL_TEN_LONG},
l AS (SELECT tag, ts, pos, lag(value, 1) OVER (PARTITION BY tag ORDER BY pos) AS v FROM ten_long),
e AS (
  SELECT tag, ts, pos,
    sum(CASE WHEN v IS NOT NULL THEN v * pow({_D!r}, -pos) END) OVER (PARTITION BY tag ORDER BY pos) AS n,
    sum(CASE WHEN v IS NOT NULL THEN pow({_D!r}, -pos) END) OVER (PARTITION BY tag ORDER BY pos) AS d
  FROM l)
SELECT tag, ts, {sql_r('lag(n / nullif(d, 0), 2) OVER (PARTITION BY tag ORDER BY pos)')} AS dosing
FROM e
""")
def win_lag_ewm_lag(spark, sf_dir):
    """WIN6: lag 1 → EWM → lag 2 chain (dosing features)."""
    d = W.positional(_ten_long(spark, sf_dir), KEYS, "pos",
                     lambda w: {"v": F.lag("value", 1).over(w)}, back=1, bucket_rows=BUCKET)
    e = W.ewm_mean(d, KEYS, "pos", "v", HALFLIFE, "e", bucket_rows=BUCKET)
    out = W.positional(e, KEYS, "pos", lambda w: {"dosing": F.lag("e", 2).over(w)},
                       back=2, bucket_rows=BUCKET)
    return finish(out.select("tag", "ts", "dosing"))


# ------------------------------------------------------------------- NULL runs
@register("null_runs", f"""
WITH {SQL_TEN_LONG},
g AS (SELECT tag, pos, value,
        count(value) OVER (PARTITION BY tag ORDER BY pos) AS grp FROM ten_long),
runs AS (SELECT tag, grp, count(*) AS run_len, max(pos) AS run_end
         FROM g WHERE value IS NULL GROUP BY tag, grp),
last_nn AS (SELECT tag, max(pos) AS last_nn FROM ten_long WHERE value IS NOT NULL GROUP BY tag),
tags AS (SELECT DISTINCT tag FROM ten_long),
kept AS (
  SELECT g.tag, count(*) AS rows_kept FROM g
  LEFT JOIN runs r ON g.tag = r.tag AND g.grp = r.grp AND g.value IS NULL
  LEFT JOIN last_nn l ON g.tag = l.tag
  WHERE NOT coalesce(r.run_len >= 6 AND r.run_end < l.last_nn, false)
  GROUP BY g.tag)
SELECT t.tag, coalesce((SELECT max(run_len) FROM runs r WHERE r.tag = t.tag), 0) AS max_null_run,
       k.rows_kept
FROM tags t JOIN kept k USING (tag)
""")
def null_runs(spark, sf_dir):
    """AGG8 longest NULL run per tag and FLT11 rows kept after removing closed
    NULL runs of ≥ 6 slots, both as carry scans over bucket summaries."""
    d = _ten_long(spark, sf_dir)
    mx = W.max_null_run(d, KEYS, "pos", "value", BUCKET)
    kept = (W.remove_long_null_runs(d, KEYS, "pos", "value", max_run=6, bucket_rows=BUCKET)
            .groupBy("tag").agg(F.count(F.lit(1)).alias("rows_kept")))
    return finish(mx.join(kept, "tag"))


# ------------------------------------------------------------------- dense index
@register("row_lags_by_asset", f"""
SELECT (user_id % 8)::INTEGER AS asset, event_id,
       row_number() OVER (PARTITION BY user_id % 8 ORDER BY ts) - 1 AS pos,
       {sql_r('value - lag(value, 1) OVER (PARTITION BY user_id % 8 ORDER BY ts)')} AS diff_1,
       {sql_r('avg(value) OVER (PARTITION BY user_id % 8 ORDER BY ts ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)')} AS roll_3
FROM events
""")
def row_lags_by_asset(spark, sf_dir):
    """Dense row index per asset on raw rows (no grid), then WIN1/WIN3 by row."""
    d = FX.long_sensors(spark, sf_dir)
    d = W.dense_index(d, ["asset"], "ts")
    out = W.positional(d, ["asset"], "pos", lambda w: {
        "diff_1": W.diff_expr("value", 1, w),
        "roll_3": F.avg("value").over(w.rowsBetween(-2, 0))}, back=2, bucket_rows=BUCKET)
    return finish(out.select("asset", "event_id", "pos", "diff_1", "roll_3"))
