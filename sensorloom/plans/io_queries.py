"""Registered queries: JSON cells, calendar resampling and small aggregates (§2.1, §2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F


from sensorloom.operators import resample as R
from sensorloom.sources import fixtures as FX
from sensorloom.sources import io as IO
from sensorloom.plans.common import SQL_HOURLY, finish, register, sql_bin_left, sql_r
from sensorloom.sources.fixtures import TAGS


@register("props_json", """
SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_id FROM events
""")
def props_json(spark, sf_dir):
    """F13/SRC3: JSON text cells parsed with ``from_json``."""
    ev = FX.events(spark, sf_dir).select("event_id", "event_type", "props")
    return finish(IO.parse_props(ev).select("event_type", "k", "event_id"))


@register("calendar_resample", f"""
SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS ts, {", ".join(sql_r(f"sum(value) FILTER (WHERE event_type = '{t}')") + f" AS {t}" for t in TAGS)}
FROM events GROUP BY 1
UNION ALL
SELECT CAST(last_day(CAST(ts AS DATE)) AS TIMESTAMP), {", ".join(sql_r(f"max(value) FILTER (WHERE event_type = '{t}')") + f" AS {t}" for t in TAGS)}
FROM events GROUP BY 1
""")
def calendar_resample(spark, sf_dir):
    """AGG17: daily sum and month-end-labelled monthly max per tag."""
    ev = FX.events(spark, sf_dir).select("ts", *[F.when(F.col("event_type") == t, F.col("value")).alias(t)
                                                 for t in TAGS])
    return finish(R.calendar_resample(ev, "day", "sum", cols=TAGS)
                  .unionByName(R.calendar_resample(ev, "month", "max", cols=TAGS)))


@register("resample_hour_4h", f"""
WITH a AS (SELECT {sql_bin_left("ts", 3600)} AS ts, event_type, value FROM events),
h AS (SELECT ts, {", ".join(f"avg(value) FILTER (WHERE event_type = '{t}') AS {t}" for t in TAGS)} FROM a GROUP BY 1),
b AS (SELECT {sql_bin_left("ts", 14400, 10800)} AS ts, {", ".join(TAGS)} FROM h)
SELECT ts, {", ".join(sql_r(f"avg({t})") + f" AS {t}" for t in TAGS)} FROM b GROUP BY 1
""")
def resample_hour_4h(spark, sf_dir):
    """AGG3 hourly means then AGG4 4-hour means with base 23 (bins at 03, 07, …, 23)."""
    ev = FX.events(spark, sf_dir).select("ts", *[F.when(F.col("event_type") == t, F.col("value")).alias(t)
                                                 for t in TAGS])
    hourly = R.data_group_per_hour(ev, cols=TAGS)
    return finish(R.resample(hourly, "4H", "3H", cols=TAGS, how="mean", closed="left", keep_empty=False))


@register("plant_aggregates", f"""
WITH h AS ({SQL_HOURLY})
SELECT 'all' AS scope,
  {sql_r("sum(click * view + purchase * signup) / nullif(sum(view + signup), 0)")} AS weighted,
  {sql_r("avg(purchase) FILTER (WHERE ts < TIMESTAMP '2024-01-15 00:00:00')")} AS mean_before,
  {sql_r("avg(purchase) FILTER (WHERE ts >= TIMESTAMP '2024-01-15 00:00:00')")} AS mean_after,
  {sql_r("avg(purchase) FILTER (WHERE hour(ts) BETWEEN 8 AND 19)")} AS day_mean,
  {sql_r("median(purchase)")} AS median_purchase
FROM h
""")
def plant_aggregates(spark, sf_dir):
    """AGG18 weighted average (weights are tags), AGG19 mean before/after a
    date (drift screen), AGG20 group mean with a key filter, AGG16 median."""
    h = FX.hourly_wide(spark, sf_dir)
    w = F.sum(F.col("click") * F.col("view") + F.col("purchase") * F.col("signup"))
    d = F.sum(F.col("view") + F.col("signup"))
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    out = h.agg(F.lit("all").alias("scope"),
                F.when(d != 0, w / d).alias("weighted"),
                F.avg(F.when(F.col("ts") < cut, F.col("purchase"))).alias("mean_before"),
                F.avg(F.when(F.col("ts") >= cut, F.col("purchase"))).alias("mean_after"),
                F.avg(F.when(F.hour("ts").between(8, 19), F.col("purchase"))).alias("day_mean"),
                F.median("purchase").alias("median_purchase"))
    return finish(out)



