"""Registered queries: cleaning, filters, de-duplication, projections (§2.2–2.4)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from sensorloom.functions.exprs import clip, cut, magnitude_gate, non_negative, safe_div
from sensorloom.operators import clean as C
from sensorloom.operators import filters as FL
from sensorloom.operators import joins as J
from sensorloom.operators import projection as P
from sensorloom.operators import resample as R
from sensorloom.plans.common import (
    SQL_HOURLY, SQL_TEN_MIN, finish, register, sql_bin_left, sql_bin_right, sql_r,
)
from sensorloom.sources import fixtures as FX
from sensorloom.sources.fixtures import AS_OF, SHUTDOWNS, TAGS

H = f"WITH h AS ({SQL_HOURLY})"


def _ts_sql(d: datetime) -> str:
    return f"TIMESTAMP '{d:%Y-%m-%d %H:%M:%S}'"


# ------------------------------------------------------------------ CLN row-wise
@register("clean_cut_clip", f"""{H}
SELECT ts,
  {sql_r("CASE WHEN click BETWEEN 10 AND 100 THEN click END")} AS click,
  {sql_r("CASE WHEN error BETWEEN 0 AND 95 THEN error END")} AS error,
  {sql_r("CASE WHEN signup BETWEEN 0 AND 95 THEN signup END")} AS signup,
  {sql_r("CASE WHEN purchase > 80 THEN 80 WHEN purchase < 20 THEN 20 ELSE purchase END")} AS purchase,
  {sql_r("CASE WHEN abs(view) > 60 THEN 0 ELSE view END")} AS view,
  {sql_r("CASE WHEN purchase - 50 < 0 THEN 0 ELSE purchase - 50 END")} AS purchase_pos,
  {sql_r("CASE WHEN view = 0 THEN CASE WHEN click = 0 THEN NULL ELSE 0 END ELSE click / view END")} AS click_per_view
FROM h
""")
def clean_cut_clip(spark, sf_dir):
    """CLN1 cut by dict, CLN2/CLN11 cut by list, CLN3 clip, CLN12 magnitude gate,
    CLN14 negatives → 0, CLN10 guarded divide."""
    h = FX.hourly_wide(spark, sf_dir)
    h = h.withColumns({"_p": F.col("purchase"), "_v": F.col("view"), "_c": F.col("click")})
    h = C.cut_values_from_dict(h, {"click": (10, 100)})
    h = C.cut_values_from_list(h, ["error", "signup"], (0, 95))
    out = h.select(
        "ts", "click", "error", "signup",
        clip("_p", 20, 80).alias("purchase"),
        magnitude_gate("_v", 60).alias("view"),
        non_negative(F.col("_p") - 50).alias("purchase_pos"),
        safe_div("_c", "_v", fill=0).alias("click_per_view"),
    )
    return finish(out)


@register("clean_outlier_stats", f"""{H},
l AS (SELECT ts, tag, value FROM h UNPIVOT INCLUDE NULLS (value FOR tag IN (click, view)))
SELECT tag,
  count(*) FILTER (WHERE value > 150) AS count_high,
  count(*) FILTER (WHERE value < 10) AS count_low,
  count(value) AS total,
  count(*) FILTER (WHERE ts >= {_ts_sql(AS_OF)} - INTERVAL 7 DAY AND value > 150) AS count_high_7d,
  count(*) FILTER (WHERE ts >= {_ts_sql(AS_OF)} - INTERVAL 7 DAY AND value < 10) AS count_low_7d,
  count(value) FILTER (WHERE ts >= {_ts_sql(AS_OF)} - INTERVAL 7 DAY) AS total_7d,
  count(*) FILTER (WHERE ts >= {_ts_sql(AS_OF)} - INTERVAL 14 DAY AND value > 150) AS count_high_14d,
  count(*) FILTER (WHERE ts >= {_ts_sql(AS_OF)} - INTERVAL 14 DAY AND value < 10) AS count_low_14d,
  count(value) FILTER (WHERE ts >= {_ts_sql(AS_OF)} - INTERVAL 14 DAY) AS total_14d,
  10.0 AS low_value, 150.0 AS high_value
FROM l GROUP BY tag
""")
def clean_outlier_stats(spark, sf_dir):
    """AGG9: per-tag outlier counts overall and in trailing 7/14-day windows (one aggregate)."""
    lim = {"click": {"low_value": 10.0, "high_value": 150.0},
           "view": {"low_value": 10.0, "high_value": 150.0}}
    return finish(C.outlier_value_stats(FX.hourly_wide(spark, sf_dir), lim, AS_OF,
                                        windows_days=(7, 14)))


def _dict_sql() -> str:
    rows = []
    for r in FX.TAG_DICT_ROWS:
        lo = "NULL" if r[5] is None else repr(r[5])
        hi = "NULL" if r[6] is None else repr(r[6])
        rows.append(f"('{r[0]}', CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE))")
    return "td(tag, range_min, range_max) AS (VALUES " + ", ".join(rows) + ")"


@register("clean_range_by_dict", f"""
WITH {_dict_sql()}
SELECT e.event_id, e.event_type AS tag,
  {sql_r("CASE WHEN (td.range_min IS NOT NULL AND e.value < td.range_min) OR (td.range_max IS NOT NULL AND e.value > td.range_max) THEN NULL ELSE e.value END")} AS value
FROM events e LEFT JOIN td ON td.tag = e.event_type
""")
def clean_range_by_dict(spark, sf_dir):
    """CLN4: long rows outside the dictionary range of their tag → NULL (one-sided ranges)."""
    long = FX.events(spark, sf_dir).select("event_id", F.col("event_type").alias("tag"), "value")
    out = C.replace_outliers_by_nan(long, FX.tag_dictionary(spark))
    return finish(out.select("event_id", "tag", "value"))


@register("clean_quantile_cut", f"""{H},
q AS (SELECT {", ".join(f"quantile_cont({t}, 0.05) AS lo_{t}, quantile_cont({t}, 0.95) AS hi_{t}" for t in TAGS)} FROM h)
SELECT ts, {", ".join(sql_r(f"CASE WHEN {t} BETWEEN lo_{t} AND hi_{t} THEN {t} END") + f" AS {t}" for t in TAGS)}
FROM h, q
""")
def clean_quantile_cut(spark, sf_dir):
    """CLN5: values outside the column's own 5 %–95 % quantiles → NULL."""
    return finish(C.remove_outliers_quantile(FX.hourly_wide(spark, sf_dir), TAGS, 0.05, 0.95))


def _esp_sql() -> str:
    clipped = ", ".join(
        f"CASE WHEN {t} > p99_{t} THEN p99_{t} WHEN {t} < p0_{t} THEN p0_{t} ELSE {t} END AS {t}"
        for t in TAGS)
    q1 = ", ".join(f"quantile_cont({t}, 0.0) AS p0_{t}, quantile_cont({t}, 0.99) AS p99_{t}"
                   for t in TAGS)
    q2 = ", ".join(f"quantile_cont({t}, 0.5) AS med_{t}, quantile_cont({t}, 0.95) AS p95_{t}"
                   for t in TAGS)
    q3 = ", ".join(f"stddev_samp(CASE WHEN {t} < p95_{t} THEN {t} END) AS sd_{t}" for t in TAGS)
    outc = ", ".join(sql_r(f"CASE WHEN {t} > med_{t} + 10 * sd_{t} THEN med_{t} + 10 * sd_{t} ELSE {t} END")
                     + f" AS {t}" for t in TAGS)
    return f"""{H},
q1 AS (SELECT {q1} FROM h),
c AS (SELECT ts, {clipped} FROM h, q1),
q2 AS (SELECT {q2} FROM c),
q3 AS (SELECT {q3} FROM c, q2)
SELECT ts, {outc} FROM c, q2, q3"""


@register("clean_esp_outliers", _esp_sql())
def clean_esp_outliers(spark, sf_dir):
    """CLN6: clip at own p0/p99, cap at median + 10·std (std of values < p95)."""
    return finish(C.remove_outliers_esp(FX.hourly_wide(spark, sf_dir), TAGS))


@register("clean_impute", f"""
WITH {SQL_TEN_MIN},
m AS (SELECT {", ".join(f"median({t}) AS m_{t}" for t in TAGS)} FROM ten)
SELECT ts, {", ".join(sql_r(f"greatest(coalesce({t}, m_{t}), 0)") + f" AS {t}" for t in TAGS)}
FROM ten, m
""")
def clean_impute(spark, sf_dir):
    """CLN7: NULL → column median, then negatives → 0 (10-minute grid with gaps)."""
    ten = FX.ten_minute_wide(spark, sf_dir).drop("pos")
    return finish(C.data_imputation(ten, TAGS))


# ------------------------------------------------------------------ filters
_SHUT_SQL = " AND ".join(f"NOT (ts BETWEEN {_ts_sql(a)} AND {_ts_sql(b)})" for a, b in SHUTDOWNS)


@register("filter_dates", f"""{H}
SELECT ts, {", ".join(sql_r(t) + " AS " + t for t in TAGS)}
FROM h
WHERE ts >= {_ts_sql(AS_OF)} - INTERVAL 30 DAY AND ts <= TIMESTAMP '2024-01-25 00:00:00'
  AND {_SHUT_SQL}
""")
def filter_dates(spark, sf_dir):
    """FLT1 date range from an explicit as-of (months=1, end date) + FLT4 shutdowns."""
    h = FX.hourly_wide(spark, sf_dir)
    h = FL.filter_date_range(h, AS_OF, 1, end_date=datetime(2024, 1, 25))
    return finish(FL.remove_shut_downs(h, SHUTDOWNS))


@register("filter_shutdown_join", f"""
SELECT event_id, ts, {sql_r('value')} AS value FROM events WHERE {_SHUT_SQL}
""")
def filter_shutdown_join(spark, sf_dir):
    """FLT2/FLT4 as an interval anti join against the (size-checked) interval table."""
    ev = FX.events(spark, sf_dir).select("event_id", "ts", "value")
    return finish(J.exclude_intervals(ev, FX.shutdowns(spark)))


@register("filter_predicates", f"""{H}
SELECT ts, {", ".join(sql_r(t) + " AS " + t for t in TAGS)}
FROM h
WHERE ((ts BETWEEN TIMESTAMP '2024-01-02 00:00:00' AND TIMESTAMP '2024-01-08 00:00:00')
    OR (ts BETWEEN TIMESTAMP '2024-01-20 00:00:00' AND TIMESTAMP '2024-01-27 00:00:00'))
  AND error < 90
  AND coalesce(click > 5 AND click < 200 AND view > 5, false)
  AND signup BETWEEN 0 AND 300 AND purchase BETWEEN 0 AND 300
  AND purchase IS NOT NULL AND error IS NOT NULL
""")
def filter_predicates(spark, sf_dir):
    """FLT15 two date ranges, FLT5 threshold, FLT7 stable conditions, FLT12
    envelope, FLT13 NULL drop — all pushed-down predicates."""
    h = FX.hourly_wide(spark, sf_dir)
    h = FL.two_date_ranges(h, (datetime(2024, 1, 2), datetime(2024, 1, 8)),
                           (datetime(2024, 1, 20), datetime(2024, 1, 27)))
    h = FL.threshold_filter(h, "error", 90)
    h = FL.stable_conditions(h, {"click": (5, 200), "view": (5, None)})
    h = FL.envelope_filter(h, {"signup": (0, 300), "purchase": (0, 300)})
    h = FL.drop_null_rows(h, ["purchase", "error"])
    return finish(h)


@register("filter_flags_nulls", f"""{H}
SELECT ts, (CASE WHEN click IS NULL OR click < 20 THEN 0 ELSE 1 END) AS click_on,
       (CASE WHEN view IS NULL OR view > 90 THEN 0 ELSE 1 END) AS view_on
FROM h
WHERE (CASE WHEN click IS NULL OR click < 20 THEN 0 ELSE 1 END) = 1
  AND (CASE WHEN view IS NULL OR view > 90 THEN 0 ELSE 1 END) = 1
UNION ALL
SELECT ts, -1 AS click_on, -1 AS view_on FROM h WHERE purchase IS NULL OR signup IS NULL
""")
def filter_flags_nulls(spark, sf_dir):
    """FEA9 on/off flags + FLT18: rows with every flag on, and rows missing a target."""
    from sensorloom.functions.exprs import on_off
    h = FX.hourly_wide(spark, sf_dir)
    flags = h.select("ts", on_off("click", "less_than", 20).alias("click_on"),
                     on_off("view", "greater_than", 90).alias("view_on"))
    on = FL.all_flags_on(flags, ["click_on", "view_on"])
    missing = FL.any_null(h, ["purchase", "signup"]).select(
        "ts", F.lit(-1).alias("click_on"), F.lit(-1).alias("view_on"))
    return finish(on.unionByName(missing))


@register("filter_target_shift", f"""
WITH h AS ({SQL_HOURLY}),
agg AS (SELECT {sql_bin_right("ts", 7200, 82800)} AS ts, avg(purchase) AS purchase,
               count(purchase) AS calc_count_purchase FROM h GROUP BY 1),
j AS (SELECT a.ts, a.purchase, a.calc_count_purchase, p.purchase AS calc_p1_lag_purchase
      FROM agg a LEFT JOIN agg p ON p.ts = a.ts + INTERVAL 2 HOUR)
SELECT ts, {sql_r('purchase')} AS purchase, calc_count_purchase,
       {sql_r('calc_p1_lag_purchase')} AS calc_p1_lag_purchase
FROM j
WHERE purchase > 20 AND purchase < 80 AND calc_p1_lag_purchase > 20 AND calc_p1_lag_purchase < 80
  AND calc_count_purchase > 1
  AND ts BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-28 00:00:00'
""")
def filter_target_shift(spark, sf_dir):
    """FLT3: target range, next-shift target range, count and date filters."""
    h = FX.hourly_wide(spark, sf_dir)
    agg = R.group_by_shift(h, "2H", "23H", cols=["purchase"], count_cols=["purchase"])
    agg = agg.join(agg.select(F.timestamp_add("HOUR", F.lit(-2), "ts").alias("ts"),
                              F.col("purchase").alias("calc_p1_lag_purchase")), "ts", "left")
    out = FL.filter_target(agg, "purchase", current=(20, 80), lag_p1=(20, 80), count=1,
                           start=datetime(2024, 1, 3), end=datetime(2024, 1, 28))
    return finish(out.select("ts", "purchase", "calc_count_purchase", "calc_p1_lag_purchase"))


@register("dedupe_keep_last", f"""
SELECT {sql_bin_left("ts", 3600)} AS ts, max(event_id) AS event_id,
       arg_max(event_type, event_id) AS event_type, {sql_r("arg_max(value, event_id)")} AS value
FROM events GROUP BY 1
""")
def dedupe_keep_last(spark, sf_dir):
    """FLT8: one row per (hour) timestamp, the last in ingest order."""
    d = FL.dedupe(FX.hourly_duplicates(spark, sf_dir), ["ts"], "event_id", keep="last")
    return finish(d.select("ts", "event_id", "event_type", "value"))


@register("dedupe_keep_first", f"""
SELECT {sql_bin_left("ts", 3600)} AS ts, min(event_id) AS event_id,
       arg_min(event_type, event_id) AS event_type, {sql_r("arg_min(value, event_id)")} AS value
FROM events GROUP BY 1
""")
def dedupe_keep_first(spark, sf_dir):
    """FLT9: one row per (hour) timestamp, the first in ingest order."""
    d = FL.dedupe(FX.hourly_duplicates(spark, sf_dir), ["ts"], "event_id", keep="first")
    return finish(d.select("ts", "event_id", "event_type", "value"))


@register("distinct_rows", f"""
SELECT DISTINCT {sql_bin_left("ts", 3600)} AS ts, event_type FROM events
""")
def distinct_rows(spark, sf_dir):
    """FLT10: full-row distinct."""
    return finish(FL.distinct_rows(FX.hourly_duplicates(spark, sf_dir).select("ts", "event_type")))


@register("above_own_p10", f"""
WITH r AS (SELECT l_orderkey, l_linenumber,
             3.0 * l_quantity - 40.0 * l_discount + 25.0 * l_tax + ((l_partkey % 7) - 3) / 10.0 AS y
           FROM lineitem)
SELECT l_orderkey, l_linenumber, {sql_r('y')} AS y FROM r
WHERE y > (SELECT quantile_cont(y, 0.1) FROM r)
""")
def above_own_p10(spark, sf_dir):
    """FLT14: keep rows whose target exceeds its own 10th percentile."""
    r = FX.regression_table(spark, sf_dir).select("l_orderkey", "l_linenumber", "y")
    return finish(FL.above_own_quantile(r, "y", 0.1))


@register("latest_rows", f"""{H}
SELECT ts, {", ".join(sql_r(t) + " AS " + t for t in TAGS)} FROM h
WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'
ORDER BY ts DESC LIMIT 24
""")
def latest_rows(spark, sf_dir):
    """FLT6 + LIM1: inclusive time slice, then the last 24 rows (top-n is the feature)."""
    h = FX.hourly_wide(spark, sf_dir)
    return finish(FL.filter_timestamp_optimization(h, datetime(2024, 1, 10), datetime(2024, 1, 20),
                                                   mode="end", n=24))


# ------------------------------------------------------------------ projections
def _raw_names_frame(spark, sf_dir):
    """A historian-style export: mixed-case names with punctuation, text values."""
    h = FX.hourly_wide(spark, sf_dir)
    return h.select(F.col("ts").alias("Fecha"),
                    F.col("click").cast("string").alias("Click: Rate"),
                    F.col("view").cast("string").alias("View-Rate.PV"),
                    F.regexp_replace(F.col("purchase").cast("string"), r"\.", ",").alias("Purchase, t'h"),
                    F.col("error").cast("string").alias("Error Rate"),
                    F.col("error").cast("string").alias("error_rate"))


@register("project_names", f"""{H}
SELECT ts AS fecha,
  {sql_r('click')} AS click__rate,
  {sql_r('view')} AS view_rate_pv,
  {sql_r('purchase')} AS purchase__th,
  {sql_r('error')} AS error_rate,
  {sql_r('click * 3.6')} AS click_m3h,
  {sql_r('click * 3.6 + view')} AS flow_total
FROM h
""")
def project_names(spark, sf_dir):
    """PRJ1/PRJ3 name parsing + numeric coercion + duplicate-name drop, PRJ4
    decimal comma, PRJ9 ordered expressions, PRJ14 unit conversion."""
    raw = _raw_names_frame(spark, sf_dir)
    fixed = raw.withColumn("Purchase, t'h", P.decimal_comma("Purchase, t'h"))
    d = P.parse_and_coerce(fixed, "Fecha")
    d = P.numexpr_eval(d, ["click_m3h = click__rate * 3.6", "flow_total = click_m3h + view_rate_pv"])
    return finish(d)


@register("project_select_drop", f"""
WITH {SQL_TEN_MIN}
SELECT ts, {", ".join(sql_r(t) + " AS " + t for t in TAGS if t != "error")}, {sql_r("click")} AS cam_1, {sql_r("view")} AS cam_2, {sql_r("click")} AS cam_3 FROM ten
""")
def project_select_drop(spark, sf_dir):
    """PRJ5 select by regex, PRJ6 drop by list, PRJ7 drop all-NULL, PRJ8 NULL-share
    threshold, PRJ10 new columns only, PRJ11 alias cycling."""
    ten = FX.ten_minute_wide(spark, sf_dir)
    d = ten.withColumn("empty_tag", F.lit(None).cast("double"))
    d = P.drop_all_null(d)
    d = P.drop_columns_thres(d, 80.0)
    d = P.select_columns(d, regex=r"^(ts|pos|click|error|purchase|signup|view)$")
    d = P.drop_columns(d, items=["pos"])
    bases = [c for c in ("click", "view") if c in d.columns]  # columns kept by the screens
    d = P.alias_cycle(d, bases, ["cam_1", "cam_2", "cam_3"]) if bases else d
    d = P.only_new_columns(d, ["error"], keep=["ts"])
    return finish(d)


@register("run_ids", f"""{H}
SELECT sha256(strftime(ts, '%Y-%m-%d %H:%M:%S') || '|' || 'r2') AS run_id, ts FROM h
""")
def run_ids(spark, sf_dir):
    """PRJ12: deterministic run id from (ts, unit) — stable under task retries."""
    h = FX.hourly_wide(spark, sf_dir).select("ts", F.lit("r2").alias("unit"))
    return finish(P.with_run_id(h, ["ts", "unit"]).select("run_id", "ts"))
