"""Registered queries: expectations and anomaly detectors (§2.11 QC12–QC18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.operators import expect as X
from sensorloom.plans.common import SQL_HOURLY, SQL_TEN_LONG, finish, register, sql_r
from sensorloom.sources import fixtures as FX
from sensorloom.sources.fixtures import TAGS

BUCKET = 1024
RANGES = {"click": (0.0, 100.0), "error": (0.0, None), "signup": (None, 100.0), "view": (0.0, 100.0)}


def _range_pred(c, lo, hi):
    parts = []
    if lo is not None:
        parts.append(f"{c} < {lo}")
    if hi is not None:
        parts.append(f"{c} > {hi}")
    return " OR ".join(parts)


@register("expect_suite", f"""
WITH h AS ({SQL_HOURLY}),
a AS (SELECT count(*) AS n, {", ".join(f"count(*) FILTER (WHERE {t} IS NULL) AS null_{t}" for t in TAGS)},
             {", ".join(f"count(*) FILTER (WHERE {_range_pred(c, lo, hi)}) AS range_{c}" for c, (lo, hi) in RANGES.items())},
             count(*) FILTER (WHERE click IS DISTINCT FROM view) AS pair FROM h)
SELECT 'column_exists' AS "check", c AS "column", c <> 'missing_tag' AS success,
       CASE WHEN c <> 'missing_tag' THEN 'true' ELSE 'false' END AS observed
FROM (SELECT unnest([{", ".join(f"'{t}'" for t in TAGS + ['missing_tag'])}]) AS c)
UNION ALL SELECT 'row_count_between', NULL, n BETWEEN 100 AND 10000, CAST(n AS VARCHAR) FROM a
{"".join(f" UNION ALL SELECT 'not_null', '{t}', null_{t} = 0, CAST(null_{t} AS VARCHAR) FROM a" for t in TAGS)}
{"".join(f" UNION ALL SELECT 'between_tag_range', '{c}', range_{c} = 0, CAST(range_{c} AS VARCHAR) FROM a" for c in RANGES)}
UNION ALL SELECT 'pair_equal', 'click=view', pair = 0, CAST(pair AS VARCHAR) FROM a
""")
def expect_suite(spark, sf_dir):
    """QC12: existence, row count, not-NULL, dictionary ranges, sensor pair — one aggregate."""
    h = FX.hourly_wide(spark, sf_dir)
    return finish(X.expectation_suite(h, TAGS + ["missing_tag"], 100, 10000, RANGES,
                                      pair=("click", "view")))


W_LS, F_LS = 6, 3.0


@register("expect_anomalies", f"""
WITH {SQL_TEN_LONG},
w AS (SELECT tag, pos, value,
        CASE WHEN count(value) OVER (PARTITION BY tag ORDER BY pos ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 3
             THEN max(value) OVER (PARTITION BY tag ORDER BY pos ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
                = min(value) OVER (PARTITION BY tag ORDER BY pos ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) END AS flat,
        median(value) OVER (PARTITION BY tag ORDER BY pos ROWS BETWEEN CURRENT ROW AND {W_LS - 1} FOLLOWING)
          - median(value) OVER (PARTITION BY tag ORDER BY pos ROWS BETWEEN {W_LS} PRECEDING AND 1 PRECEDING) AS ls,
        value - median(value) OVER (PARTITION BY tag ORDER BY pos ROWS BETWEEN {W_LS} PRECEDING AND 1 PRECEDING) AS ps
      FROM ten_long),
q AS (SELECT tag, quantile_cont(value, 0.01) AS qlo, quantile_cont(value, 0.99) AS qhi,
             quantile_cont(ls, 0.25) AS l1, quantile_cont(ls, 0.75) AS l3,
             quantile_cont(ps, 0.25) AS p1, quantile_cont(ps, 0.75) AS p3 FROM w GROUP BY tag)
SELECT w.tag,
  count(*) FILTER (WHERE coalesce(flat, false)) AS n_flatline,
  count(*) FILTER (WHERE value < qlo OR value > qhi) AS n_quantile,
  count(*) FILTER (WHERE ls > l3 + {F_LS} * (l3 - l1) OR ls < l1 - {F_LS} * (l3 - l1)) AS n_level_shift,
  count(*) FILTER (WHERE ps > p3 + {F_LS} * (p3 - p1) OR ps < p1 - {F_LS} * (p3 - p1)) AS n_persist
FROM w JOIN q USING (tag) GROUP BY w.tag
""")
def expect_anomalies(spark, sf_dir):
    """QC13 flatline, QC14 quantile anomaly, WIN11 level shift, WIN12 persist
    shift — flagged row counts per tag on the 10-minute grid."""
    long = FX.ten_minute_grid_long(spark, sf_dir).select("tag", "pos", "value")
    fl = X.flatline(long, ["tag"], 3, BUCKET).groupBy("tag").agg(F.count_if("flatline").alias("n_flatline"))
    qa = X.quantile_anomaly(long, ["tag"], 0.01, 0.99).groupBy("tag").agg(F.count_if("anomaly").alias("n_quantile"))
    ls = X.level_shift(long, ["tag"], W_LS, F_LS, "both", BUCKET).groupBy("tag").agg(
        F.count_if("anomaly").alias("n_level_shift"))
    ps = X.persist_shift(long, ["tag"], W_LS, F_LS, "both", BUCKET).groupBy("tag").agg(
        F.count_if("anomaly").alias("n_persist"))
    return finish(fl.join(qa, "tag").join(ls, "tag").join(ps, "tag"))


@register("tag_histograms", f"""
WITH {SQL_TEN_LONG},
mm AS (SELECT tag, min(value) AS mn, max(value) AS mx FROM ten_long GROUP BY tag),
b AS (SELECT l.tag, CAST(CASE WHEN (mx - mn) / 30.0 = 0 THEN 0
                         ELSE least(floor((value - mn) / ((mx - mn) / 30.0)), 29) END AS INTEGER) AS bin,
             mn, mx
      FROM ten_long l JOIN mm USING (tag) WHERE value IS NOT NULL),
n AS (SELECT tag, bin, count(*) AS n FROM b GROUP BY tag, bin),
grid AS (SELECT tag, mn, mx, CAST(unnest(range(30)) AS INTEGER) AS bin FROM mm WHERE mn IS NOT NULL)
SELECT tag, bin, coalesce(n, 0) AS count, {sql_r('mn')} AS lo, {sql_r('mx')} AS hi FROM grid LEFT JOIN n USING (tag, bin)
""")
def tag_histograms(spark, sf_dir):
    """QC18: 30-bin histogram per tag (the table behind the bad-tag plots)."""
    return finish(X.histogram(FX.ten_minute_grid_long(spark, sf_dir), ["tag"], 30))


@register("expect_multivariate")
def expect_multivariate(spark, sf_dir):
    """QC16 k-means smallest-cluster anomaly and QC17 isolation forest on the
    hourly sensor vectors (rows-only: model-based, not SQL-expressible)."""
    h = FX.hourly_wide(spark, sf_dir)
    km = X.kmeans_anomaly(h, TAGS, k=3).agg(F.count_if("anomaly").alias("n")).select(
        F.lit("kmeans").alias("detector"), "n")
    iso = X.isolation_forest(h, TAGS, contamination=0.05).agg(
        F.count_if("anomaly").alias("n")).select(F.lit("isolation_forest").alias("detector"), "n")
    return finish(km.unionByName(iso))
