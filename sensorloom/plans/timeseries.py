"""Registered queries: grids, resampling, time joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.operators import grid as G
from sensorloom.operators import joins as J
from sensorloom.operators import resample as R
from sensorloom.plans.common import (
    SQL_HOURLY, finish, register, sql_bin_left, sql_bin_right, sql_r,
)
from sensorloom.session import written
from sensorloom.sources import fixtures as FX
from sensorloom.sources.fixtures import TAGS

# targets of the test dictionary (tags whose `target` text contains "target")
TARGETS = ["purchase", "signup"]


def _shift_sql() -> str:
    bin_ = sql_bin_right("ts", 7200, 82800)
    means = ", ".join(f"avg({t}) AS {t}" for t in TAGS)
    counts = ", ".join(f"count({t}) AS calc_count_{t}" for t in TARGETS)
    full_cols = ", ".join([f"a.{t}" for t in TAGS]
                          + [f"coalesce(a.calc_count_{t}, 0) AS calc_count_{t}" for t in TARGETS])
    out = ", ".join(["f.ts"] + [f"{sql_r('f.' + t)} AS {t}" for t in TAGS]
                    + [f"f.calc_count_{t}" for t in TARGETS]
                    + [f"{sql_r('p.' + t)} AS calc_p1_lag_{t}" for t in TARGETS]
                    + [f"{sql_r('m.' + t)} AS calc_m1_lag_{t}" for t in TARGETS])
    return f"""
WITH h AS ({SQL_HOURLY}),
agg AS (SELECT {bin_} AS ts, {means}, {counts} FROM h GROUP BY 1),
g AS (SELECT unnest(generate_series((SELECT min(ts) FROM agg), (SELECT max(ts) FROM agg),
                                    INTERVAL 2 HOUR)) AS ts),
f AS (SELECT g.ts, {full_cols} FROM g LEFT JOIN agg a USING (ts))
SELECT {out}
FROM f
LEFT JOIN f p ON p.ts = f.ts + INTERVAL 2 HOUR
LEFT JOIN f m ON m.ts = f.ts - INTERVAL 2 HOUR
"""


@register("shift_summary", _shift_sql())
def shift_summary(spark, sf_dir):
    """AGG1+AGG2+AGG5+JOI2+JOI4: 2-hour shift means (right-closed, offset 23 h)
    of the hourly sensors, non-NULL target counts, next and previous shift."""
    hourly = FX.hourly_wide(spark, sf_dir)
    agg = R.group_by_shift(hourly, "2H", "23H", cols=TAGS, count_cols=TARGETS)
    return finish(J.create_target_lags(written(agg, "shifts"), TARGETS, "2H"))  # three sides of the join read it


def _merge_sql() -> str:
    two = sql_bin_right("ts", 7200, 82800)
    return f"""
WITH h AS ({SQL_HOURLY}),
b AS (SELECT min(ts) + INTERVAL 30 MINUTE AS lo, max(ts) - INTERVAL 90 MINUTE AS hi FROM h),
g AS (SELECT unnest(generate_series(make_timestamp(CAST(ceil(epoch_us(lo) / 7200000000.0) AS BIGINT) * 7200000000),
                                    make_timestamp(CAST(floor(epoch_us(hi) / 7200000000.0) AS BIGINT) * 7200000000), INTERVAL 2 HOUR)) AS ts FROM b),
s AS (SELECT {two} AS ts, avg(click) AS shift_click, avg(purchase) AS shift_purchase, count(purchase) AS calc_count_purchase, count(signup) AS calc_count_signup FROM h GROUP BY 1)
SELECT g.ts, {sql_r("h.click")} AS click, {sql_r("h.view")} AS view, {sql_r("s.shift_click")} AS shift_click, {sql_r("s.shift_purchase")} AS shift_purchase,
  s.calc_count_purchase, s.calc_count_signup
FROM g LEFT JOIN h ON h.ts = g.ts LEFT JOIN s ON s.ts = g.ts
"""


@register("grid_merge", _merge_sql())
def grid_merge(spark, sf_dir):
    """AGG5 with offsets, JOI1, JOI2 and JOI3: hourly and shift tables, the latter with counts of lagged targets, merged to a two-hour grid
    that starts 30 minutes after the data and ends 90 minutes before its end; keys are checked."""
    hourly = FX.hourly_wide(spark, sf_dir)
    shifts = R.group_by_shift(hourly, "2H", "23H", cols=["click", "purchase"]).withColumnsRenamed({"click": "shift_click", "purchase": "shift_purchase"})
    shifts = R.create_target_counts(hourly, shifts, ["lag_purchase", "signup"], "2H", "23H")
    grid = G.create_time_grid([hourly], "2H", offset_start="30min", offset_end="90min")
    out = G.merge_to_grid(grid, hourly.select("ts", "click"), validate=True)
    return finish(J.merge_tables_on_timestamp([out, hourly.select("ts", "view"), shifts], validate=True))


@register("relining_by_machine", """
WITH c AS (SELECT o_custkey % 4 AS machine, min(o_orderdate) AS start_ts FROM orders
           GROUP BY o_custkey % 4, year(o_orderdate) * 2 + CASE WHEN month(o_orderdate) > 6 THEN 1 ELSE 0 END),
p AS (SELECT l_orderkey, l_linenumber, l_shipdate, l_suppkey % 5 AS machine FROM lineitem)
SELECT p.*, CAST(floor((epoch_us(p.l_shipdate) - epoch_us(c.start_ts)) / 86400000000) AS BIGINT) AS days_since_relining
FROM p ASOF LEFT JOIN c ON p.machine = c.machine AND p.l_shipdate >= c.start_ts
""")
def relining_by_machine(spark, sf_dir):
    """JOI7 with machine keys: each of four machines has its own campaigns, a fifth has none."""
    o = FX.table(spark, sf_dir, "orders").select((F.col("o_custkey") % 4).alias("machine"), "o_orderdate")
    half = F.year("o_orderdate") * 2 + F.when(F.month("o_orderdate") > 6, 1).otherwise(0)
    ref = o.groupBy("machine", half.alias("campaign")).agg(F.min("o_orderdate").alias("start_ts"))
    li = FX.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", (F.col("l_suppkey") % 5).alias("machine"))
    return finish(J.days_since_last(li, ref, "l_shipdate", "start_ts", "days_since_relining", ["machine"]))
