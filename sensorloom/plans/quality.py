"""Registered queries: data-quality statistics, screens, dictionary (§2.11)."""

from __future__ import annotations

from datetime import datetime

from functools import reduce

from pyspark.sql import functions as F

from sensorloom.operators import quality as Q
from sensorloom.operators import tags as TG
from sensorloom.plans.common import SQL_TEN_LONG, finish, register, sql_r
from sensorloom.session import written
from sensorloom.sources import fixtures as FX

BUCKET = 1024
# KS windows on one month of data: start every 7 days, 14-day base, next 7 days
KS_STEP, KS_BASE, KS_NEXT = 7, 14, 7
SCREEN = {"null_pct": 60.0, "max_null_window": 12, "ks_unstable": 50.0, "kurtosis": 6.0,
          "count_unique": 5, "pct_n_most_common": 60.0}


def _long(spark, sf_dir):
    return FX.ten_minute_grid_long(spark, sf_dir)


def _ks_windows(spark, long):
    b = long.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    start = datetime(b["lo"].year, b["lo"].month, b["lo"].day)
    end = datetime(b["hi"].year, b["hi"].month, b["hi"].day)
    return Q.ks_windows(spark, start, end, KS_STEP, KS_BASE, KS_NEXT)


_MONTHLY_SQL = f"""
m AS (SELECT tag, strftime(ts, '%Y-%m') AS month,
             round(100.0 * count(*) FILTER (WHERE value IS NULL) / count(*), 2) AS null_pct
      FROM ten_long GROUP BY 1, 2),
stat_na AS (SELECT tag, CAST(count(null_pct) AS DOUBLE) AS count, avg(null_pct) AS mean,
                   stddev_samp(null_pct) AS std, min(null_pct) AS min,
                   quantile_cont(null_pct, 0.25) AS p25, quantile_cont(null_pct, 0.5) AS p50,
                   quantile_cont(null_pct, 0.75) AS p75, max(null_pct) AS max
            FROM m GROUP BY tag)"""

_CONC_SQL = """
vc AS (SELECT tag, value, count(*) AS n FROM ten_long WHERE value IS NOT NULL GROUP BY 1, 2),
top AS (SELECT tag, sum(n) AS top_n FROM (
          SELECT tag, n, row_number() OVER (PARTITION BY tag ORDER BY n DESC, value) AS r FROM vc)
        WHERE r <= 3 GROUP BY tag),
base AS (SELECT tag, kurtosis_pop(value) AS kurtosis,
                count(DISTINCT round_even(value, 4)) AS count_unique, count(*) AS rows_
         FROM ten_long GROUP BY tag),
conc AS (SELECT b.tag, b.kurtosis, 100.0 * coalesce(t.top_n, 0) / b.rows_ AS pct_n_most_common,
                b.count_unique FROM base b LEFT JOIN top t USING (tag))"""

_RUNS_SQL = """
g AS (SELECT tag, pos, value, count(value) OVER (PARTITION BY tag ORDER BY pos) AS grp FROM ten_long),
runs AS (SELECT tag, max(c) AS max_null_window FROM (
           SELECT tag, grp, count(*) FILTER (WHERE value IS NULL) AS c FROM g GROUP BY 1, 2)
         GROUP BY tag)"""


@register("qa_monthly_null", f"""
WITH {SQL_TEN_LONG}, {_MONTHLY_SQL}
SELECT tag, count, {sql_r('mean')} AS mean, {sql_r('std')} AS std, {sql_r('min')} AS min,
       {sql_r('p25')} AS p25, {sql_r('p50')} AS p50, {sql_r('p75')} AS p75, {sql_r('max')} AS max
FROM stat_na
""")
def qa_monthly_null(spark, sf_dir):
    """AGG7: monthly NULL % per tag, described over months."""
    return finish(Q.monthly_null_pct(_long(spark, sf_dir)))


@register("qa_concentration", f"""
WITH {SQL_TEN_LONG}, {_CONC_SQL}
SELECT tag, {sql_r('kurtosis')} AS kurtosis, {sql_r('pct_n_most_common')} AS pct_n_most_common,
       count_unique FROM conc
""")
def qa_concentration(spark, sf_dir):
    """AGG10 + TOP1 + CLN13: kurtosis, distinct rounded values, top-3 share."""
    return finish(Q.concentration(_long(spark, sf_dir)))


_EN = "sqrt(max(n1)::DOUBLE * max(n2) / (max(n1) + max(n2)))"
_LAMBDA = f"(({_EN} + 0.12 + 0.11 / {_EN}) * max(abs(ca / n1 - cb / n2)))"
_P_VALUE = (f"CASE WHEN {_LAMBDA} < 0.04 THEN 1.0 ELSE least(greatest(list_sum(list_transform(range(1, 101), "
            f"lambda k: 2.0 * CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END * exp(-2.0 * k * k * {_LAMBDA} * {_LAMBDA}))), 0.0), 1.0) END")


def _ks_sql() -> str:
    return f"""
WITH {SQL_TEN_LONG},
b AS (SELECT CAST(min(ts) AS DATE) AS d0, CAST(max(ts) AS DATE) AS d1 FROM ten_long),
wins AS (
  SELECT CAST(d0 AS TIMESTAMP) + to_days(CAST(k * {KS_STEP} AS INTEGER)) AS start1 FROM b,
         range(0, 1000) t(k)
  WHERE CAST(d0 AS TIMESTAMP) + to_days(CAST(k * {KS_STEP} + {KS_BASE} + {KS_NEXT} AS INTEGER))
        <= CAST(d1 AS TIMESTAMP)),
w AS (SELECT start1, start1 + INTERVAL {KS_BASE - 1} DAY AS end1,
             start1 + INTERVAL {KS_BASE} DAY AS start2,
             start1 + INTERVAL {KS_BASE + KS_NEXT} DAY AS end2 FROM wins),
j AS (SELECT l.tag, w.start1, w.end2, l.value,
             CAST(l.ts BETWEEN w.start1 AND w.end1 AS INTEGER) AS a,
             CAST(l.ts BETWEEN w.start2 AND w.end2 AS INTEGER) AS b
      FROM ten_long l JOIN w ON l.ts BETWEEN w.start1 AND w.end2 WHERE l.value IS NOT NULL),
vc AS (SELECT tag, start1, end2, value, sum(a) AS a, sum(b) AS b FROM j GROUP BY 1, 2, 3, 4),
c AS (SELECT tag, start1, end2,
             sum(a) OVER (PARTITION BY tag, start1, end2 ORDER BY value) AS ca,
             sum(b) OVER (PARTITION BY tag, start1, end2 ORDER BY value) AS cb,
             sum(a) OVER (PARTITION BY tag, start1, end2) AS n1,
             sum(b) OVER (PARTITION BY tag, start1, end2) AS n2
      FROM vc)
SELECT tag, start1 AS start_date, end2 AS end_date,
       {sql_r('max(abs(ca / n1 - cb / n2))')} AS ks, CAST(max(n1) AS BIGINT) AS n1,
       CAST(max(n2) AS BIGINT) AS n2,
       CAST(max(abs(ca / n1 - cb / n2)) >= 0.5 AS INTEGER) AS is_unstable,
       {sql_r(_P_VALUE)} AS p_value
FROM c WHERE n1 > 0 AND n2 > 0 GROUP BY 1, 2, 3
"""


@register("qa_ks", _ks_sql())
def qa_ks(spark, sf_dir):
    """AGG11 + JOI17: two-sample KS per tag per rolling window (7-day step,
    14-day base vs next 7 days) on the 10-minute grid."""
    long = _long(spark, sf_dir)
    ks = Q.ks_stability(long, _ks_windows(spark, long))
    return finish(ks.select("tag", "start_date", "end_date", "ks",
                            F.col("n1").cast("long").alias("n1"),
                            F.col("n2").cast("long").alias("n2"), "is_unstable", "p_value"))


def _dict_cols_sql() -> str:
    rows = []
    for r in FX.TAG_DICT_ROWS:
        rows.append(f"('{r[0]}', '{r[2]}', {str(r[8]).upper()}, {str(r[16]).upper()})")
    return "td(tag, tag_type, derived, model_feature) AS (VALUES " + ", ".join(rows) + ")"


_QA_TABLE_SQL = f"""
WITH {SQL_TEN_LONG}, {_MONTHLY_SQL}, {_CONC_SQL}, {_RUNS_SQL}, {_dict_cols_sql()},
tags AS (SELECT DISTINCT tag FROM ten_long),
t AS (
  SELECT tags.tag, s.mean, s.std, coalesce(c.kurtosis, 0) AS kurtosis, c.pct_n_most_common,
         c.count_unique, r.max_null_window AS Max_Null_Window,
         CAST(coalesce(s.mean > 90, false) AS INTEGER) AS too_many_na_per_month,
         CAST(coalesce(r.max_null_window > 3600, false) AS INTEGER) AS too_many_consecutives_na,
         CAST(coalesce(coalesce(c.kurtosis, 0) > 200, false) AS INTEGER) AS kurtosis_thresh,
         CAST(coalesce(c.count_unique < 5, false) AS INTEGER) AS few_unique_values,
         CAST(coalesce(c.pct_n_most_common > 60, false) AS INTEGER) AS mode_freq_thresh
  FROM tags LEFT JOIN stat_na s USING (tag) LEFT JOIN conc c USING (tag) LEFT JOIN runs r USING (tag)),
qa AS (SELECT *, too_many_na_per_month + too_many_consecutives_na + kurtosis_thresh
                 + few_unique_values + mode_freq_thresh AS score FROM t)"""


@register("qa_table", _QA_TABLE_SQL + f"""
SELECT td.tag, td.tag_type, td.derived, td.model_feature,
       {sql_r('qa.mean')} AS mean, {sql_r('qa.std')} AS std, {sql_r('qa.kurtosis')} AS kurtosis,
       {sql_r('qa.pct_n_most_common')} AS pct_n_most_common, qa.count_unique, qa.Max_Null_Window,
       qa.too_many_na_per_month, qa.too_many_consecutives_na, qa.kurtosis_thresh,
       qa.few_unique_values, qa.mode_freq_thresh, qa.score
FROM td LEFT JOIN qa USING (tag)
""")
def qa_table(spark, sf_dir):
    """QC10 + JOI10 + JOI11 (+ AGG7, AGG8, AGG10): quality table joined to the dictionary."""
    long = written(_long(spark, sf_dir), "long")
    qa = Q.create_qa_table(long.select("tag").distinct(), Q.monthly_null_pct(long),
                           Q.concentration(long), Q.null_run_table(long, BUCKET))
    td = FX.tag_dictionary(spark).select("tag", "tag_type", "derived", "model_feature")
    return finish(td.join(qa, "tag", "left"))


@register("qa_go_no_go", _QA_TABLE_SQL + """,
sel AS (SELECT 'model_feature' AS feature, td.tag, qa.score FROM td LEFT JOIN qa USING (tag)
        WHERE td.model_feature AND NOT coalesce(td.derived, false)),
gs AS (SELECT feature, score, count(*) AS n_tags, array_to_string(list_sort(list(tag)), ',') AS tags FROM sel GROUP BY 1, 2)
SELECT gs.*, NOT coalesce(bool_or(score >= 2) OVER (PARTITION BY feature), false) AS go FROM gs
""")
def qa_go_no_go(spark, sf_dir):
    """QC11 + AGG14: selected non-derived tags by score per feature flag; go/no-go."""
    long = written(_long(spark, sf_dir), "long")
    qa = Q.create_qa_table(long.select("tag").distinct(), Q.monthly_null_pct(long),
                           Q.concentration(long), Q.null_run_table(long, BUCKET))
    g = Q.go_or_no_go(qa, FX.tag_dictionary(spark), ["model_feature"])
    return finish(g.withColumn("tags", F.array_join("tags", ",")))


def _screen_sql() -> str:
    t = SCREEN
    ks = _ks_sql().strip().replace("vc AS (", "ks_vc AS (").replace("FROM vc)", "FROM ks_vc)")
    head, _, tail = ks.rpartition("\nSELECT tag, start1 AS start_date")
    return f"""{head},
ks AS (SELECT tag, start1 AS start_date{tail}),
ks_sum AS (SELECT tag, 100.0 * sum(is_unstable) / (SELECT count(*) FROM w) AS pct FROM ks GROUP BY tag),
{_MONTHLY_SQL}, {_CONC_SQL}, {_RUNS_SQL},
removed AS (
  SELECT tag, '_count_monthly_na' AS reason FROM stat_na WHERE mean >= {t["null_pct"]}
  UNION ALL SELECT tag, '_max_window_na' FROM runs WHERE max_null_window >= {t["max_null_window"]}
  UNION ALL SELECT tag, '_ks_stability' FROM ks_sum WHERE pct >= {t["ks_unstable"]}
  UNION ALL SELECT tag, '_concentrated_data_kurtosis' FROM conc WHERE kurtosis >= {t["kurtosis"]}
  UNION ALL SELECT tag, '_concentrated_data_count_unique' FROM conc WHERE count_unique < {t["count_unique"]}
  UNION ALL SELECT tag, '_concentrated_data_mode_freq' FROM conc WHERE pct_n_most_common >= {t["pct_n_most_common"]})
SELECT tag, reason, CAST(NULL AS BIGINT) AS rows FROM removed
UNION ALL
SELECT tag, 'kept', count(*) FROM ten_long WHERE tag NOT IN (SELECT tag FROM removed) GROUP BY tag
"""


@register("qa_screen", _screen_sql())
def qa_screen(spark, sf_dir):
    """QC4–QC9: tags removed by each screen, with the reason (KS included)."""
    long = _long(spark, sf_dir)
    windows = _ks_windows(spark, long)
    ks = Q.ks_summary(Q.ks_stability(long, windows), windows)
    removed = Q.screen(Q.monthly_null_pct(long), Q.null_run_table(long, BUCKET), ks,
                       Q.concentration(long), SCREEN)
    kept = Q.drop_screened(long, removed).groupBy("tag").agg(F.count(F.lit(1)).alias("rows"))
    out = removed.select("tag", "reason", F.lit(None).cast("long").alias("rows")) \
        .unionByName(kept.select("tag", F.lit("kept").alias("reason"), "rows"))
    return finish(out)


IGNORE = [(datetime(2024, 1, 9, 0, 0), datetime(2024, 1, 10, 12, 0)), (datetime(2024, 1, 20, 6, 0), datetime(2024, 1, 20, 18, 0))]
RANGES = {"click": (35.0, 65.0), "view": (None, 52.0)}


def _screened(spark, sf_dir):
    """The prepared long table and the tags its screens remove."""
    gone = spark.createDataFrame(IGNORE, "start_ts timestamp_ntz, end_ts timestamp_ntz")
    long = written(Q.prepared(_long(spark, sf_dir), gone, RANGES), "prepared")
    windows = _ks_windows(spark, long)
    ks = Q.ks_summary(Q.ks_stability(long, windows), windows)
    removed = Q.screen(Q.monthly_null_pct(long), Q.null_run_table(long, BUCKET), ks, Q.concentration(long), SCREEN)
    return long, written(removed, "removed")


def _prepared_sql() -> str:
    """The screens' SQL on prepared rows: everything that reads ``ten_long`` reads them."""
    stamp = lambda t: f"TIMESTAMP '{t}'"
    out = " AND ".join(f"NOT (ts BETWEEN {stamp(a)} AND {stamp(b)})" for a, b in IGNORE)
    keep = ", ".join(f"('{t}', {'NULL' if lo is None else lo}, {'NULL' if hi is None else hi})" for t, (lo, hi) in RANGES.items())
    sql = _screen_sql().replace("ten_long AS (", "ten_all AS (", 1)
    rows = f"""rng(rtag, lo, hi) AS (VALUES {keep}),
ten_long AS (SELECT ts, tag, row_number() OVER (PARTITION BY tag ORDER BY ts) - 1 AS pos,
    CASE WHEN rtag IS NULL OR ((lo IS NULL OR value >= lo) AND (hi IS NULL OR value <= hi)) THEN value END AS value
  FROM ten_all LEFT JOIN rng ON rtag = tag WHERE {out}),
b AS ("""
    return sql.replace("b AS (", rows, 1)


@register("qa_screen_prepared", _prepared_sql())
def qa_screen_prepared(spark, sf_dir):
    """QC8 in its whole order: ignored dates and tag ranges first, then the screens QC4–QC7 and QC9."""
    long, removed = _screened(spark, sf_dir)
    kept = Q.drop_screened(long, removed).groupBy("tag").agg(F.count(F.lit(1)).alias("rows"))
    return finish(removed.select("tag", "reason", F.lit(None).cast("long").alias("rows")).unionByName(kept.select("tag", F.lit("kept").alias("reason"), "rows")))


def _removed_sql() -> str:
    head, _, _ = _prepared_sql().rpartition("SELECT tag, reason, CAST(NULL AS BIGINT)")
    return f"{head} SELECT tag, ts, {sql_r('value')} AS value, reason FROM ten_long JOIN (SELECT tag, min(reason) AS reason FROM removed GROUP BY tag) USING (tag)"


@register("qa_removed_series", _removed_sql())
def qa_removed_series(spark, sf_dir):
    """QC18: the series of the tags that the screens remove."""
    return finish(Q.removed_series(*_screened(spark, sf_dir)))


@register("tag_dictionary_checks", f"""
WITH RECURSIVE obs AS (SELECT DISTINCT event_type AS tag FROM events),
{_dict_cols_sql()},
v AS (
  SELECT 'pattern' AS rule, tag, 'contains a comma' AS detail FROM obs WHERE tag LIKE '%,%'
  UNION ALL
  SELECT 'known_values', tag, 'tag_type=' || tag_type FROM td
   WHERE tag_type NOT IN ('input','output','state','control','on_off','reaction')
  UNION ALL
  SELECT 'observed_not_in_dictionary', tag, NULL FROM obs WHERE tag NOT IN (SELECT tag FROM td)),
edges(tag, dependency) AS (VALUES ('click','pump_on'), ('view','pump_on'), ('pump_on','line_on')),
closure(tag, dependency) AS (SELECT * FROM edges UNION SELECT c.tag, e.dependency FROM closure c JOIN edges e ON e.tag = c.dependency)
SELECT 'closure' AS rule, o.tag, c.dependency AS detail FROM obs o JOIN closure c USING (tag)
UNION ALL SELECT * FROM v
""")
def tag_dictionary_checks(spark, sf_dir):
    """QC1 validation, QC2 dependency closure, QC3 add, SET4
    set difference — applied to the tags observed in the events table."""
    td = FX.tag_dictionary(spark)
    obs = FX.events(spark, sf_dir).select(F.col("event_type").alias("tag")).distinct()
    unknown = TG.missing_tags(obs, td)
    extended = TG.add_tags(td, obs.select("tag", F.lit("input").alias("tag_type"),
                                          F.lit("numeric").alias("data_type"),
                                          F.array().cast("array<string>").alias("on_off_dependencies")))
    viol = TG.validate_td(extended)
    clo = TG.dependency_closure(td).join(obs, "tag")
    out = (clo.select(F.lit("closure").alias("rule"), "tag", F.col("dependency").alias("detail"))
           .unionByName(viol)
           .unionByName(unknown.select(F.lit("observed_not_in_dictionary").alias("rule"), "tag",
                                       F.lit(None).cast("string").alias("detail"))))
    return finish(out)


@register("tag_dependencies", """
WITH RECURSIVE edges AS (
  SELECT 's' || s_suppkey AS tag, 's' || (s_suppkey // 3) AS dependency FROM supplier
  UNION SELECT 's' || s_suppkey, 's' || (s_suppkey * 7 % 31) FROM supplier WHERE s_suppkey % 4 = 0
  UNION SELECT 's' || (s_suppkey // 3), 's' || s_suppkey FROM supplier WHERE s_suppkey % 17 = 0),
r AS (SELECT * FROM edges UNION SELECT r.tag, e.dependency FROM r JOIN edges e ON e.tag = r.dependency),
n AS (SELECT dependency AS tag, count(*) AS n_dependents FROM r GROUP BY 1)
SELECT tag, count(*) AS n_dependencies, coalesce(max(n_dependents), 0) AS n_dependents, bool_or(tag = dependency) AS in_cycle,
       min(dependency) AS first, max(dependency) AS last
FROM r LEFT JOIN n USING (tag) GROUP BY tag
""")
def tag_dependencies(spark, sf_dir):
    """QC2 on a dictionary of all suppliers with chains and cycles: dependencies, dependents and cycles of every tag."""
    s = FX.table(spark, sf_dir, "supplier").select("s_suppkey")
    def tag(e):
        return F.concat(F.lit("s"), F.expr(e).cast("string"))
    rules = [("s_suppkey", "s_suppkey div 3", "true"), ("s_suppkey", "s_suppkey * 7 % 31", "s_suppkey % 4 = 0"), ("s_suppkey div 3", "s_suppkey", "s_suppkey % 17 = 0")]
    rows = reduce(lambda a, b: a.unionByName(b), [s.where(when).select(tag(a).alias("tag"), tag(b).alias("dep")) for a, b, when in rules])
    td = rows.groupBy("tag").agg(F.collect_set("dep").alias("on_off_dependencies"))
    closure = TG.dependency_closure(td)
    number = TG.dependents(closure).groupBy("tag").agg(F.count(F.lit(1)).alias("n_dependents"))
    out = closure.groupBy("tag").agg(F.count(F.lit(1)).alias("n_dependencies"), F.bool_or(F.col("tag") == F.col("dependency")).alias("in_cycle"),
                                     F.min("dependency").alias("first"), F.max("dependency").alias("last"))
    return finish(out.join(number, "tag", "left").withColumn("n_dependents", F.coalesce("n_dependents", F.lit(0).cast("long"))))


@register("tag_lookups", f"""
WITH obs AS (SELECT event_type AS tag, count(*) AS n_rows FROM events GROUP BY 1)
SELECT o.tag, o.n_rows,
  CASE o.tag WHEN 'click' THEN 'Click rate_control' WHEN 'error' THEN 'Error rate_state'
             WHEN 'purchase' THEN 'Purchase_output' WHEN 'signup' THEN 'Signup_state'
             WHEN 'view' THEN 'View rate_control' END AS display_name,
  o.tag IN ('purchase', 'signup') AS is_target,
  o.tag IN ('click', 'view') AS is_control
FROM obs o
""")
def tag_lookups(spark, sf_dir):
    """QC3 display names, FLT17 targets, FLT16 select by type, per observed tag."""
    td = FX.tag_dictionary(spark)
    obs = FX.events(spark, sf_dir).groupBy(F.col("event_type").alias("tag")).agg(
        F.count(F.lit(1)).alias("n_rows"))
    names = TG.display_name(td)
    tgt = TG.get_targets(td).withColumn("is_target", F.lit(True))
    ctl = TG.select_tags(td, "tag_type", "control").withColumn("is_control", F.lit(True))
    out = (obs.join(names, "tag", "left").join(tgt, "tag", "left").join(ctl, "tag", "left")
           .select("tag", "n_rows", "display_name",
                   F.coalesce("is_target", F.lit(False)).alias("is_target"),
                   F.coalesce("is_control", F.lit(False)).alias("is_control")))
    return finish(out)
