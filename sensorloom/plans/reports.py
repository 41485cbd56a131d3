"""Registered queries: report tables, hand-over joins, mill filling and the fine-copper chain."""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import functions as F

from sensorloom.functions.exprs import safe_div
from sensorloom.operators import attribution as A
from sensorloom.operators import reports as R
from sensorloom.plans.common import SQL_HOURLY, SQL_TEN_LONG, SQL_TEN_MIN, finish, register, sql_r
from sensorloom.plans.features import _MET_SQL, CELLS_SQL, _metallurgy, s_cut, s_div, s_rsum
from sensorloom.plans.optimisation import _runs
from sensorloom.sources import fixtures as FX

H = f"h AS ({SQL_HOURLY})"
CUT = datetime(2024, 1, 16)
CUT_SQL = "TIMESTAMP '2024-01-16 00:00:00'"
RUN_SQL = "sha256(strftime(ts, '%Y-%m-%d %H:%M:%S') || '|r2')"


def _td_values() -> str:
    """The dictionary's attributes as SQL rows (it is fixed metadata, not data)."""
    rows = ", ".join(f"('{r[0]}', '{r[2]}', '{r[9]}', {'NULL' if r[10] is None else repr(r[10])})" for r in FX.TAG_DICT_ROWS)
    return f"td(tag_id, tag_type, area, description) AS (VALUES {rows})"


@register("report_lookups", f"""
WITH {H}, {_td_values()},
c AS (SELECT {RUN_SQL} AS run_id, ts, 'click' AS tag_id, click AS value FROM h
      UNION ALL SELECT {RUN_SQL}, ts, 'other', view FROM h)
SELECT c.run_id, c.ts, c.tag_id, {sql_r('c.value')} AS value, {sql_r('h.error')} AS error, td.description, td.area, td.tag_type
FROM c JOIN h ON h.ts = c.ts LEFT JOIN td USING (tag_id)
""")
def report_lookups(spark, sf_dir):
    """JOI13 input row by (run, time), JOI14 dictionary attributes (an unknown tag keeps NULL), SRT2 order."""
    runs = _runs(spark, sf_dir)
    rows = runs.select("run_id", "ts", F.explode(F.array(
        F.struct(F.lit("click").alias("tag_id"), F.col("click").alias("value")),
        F.struct(F.lit("other").alias("tag_id"), F.col("view").alias("value")))).alias("c")).select("run_id", "ts", "c.*")
    out = R.lookup_rows(rows, runs.select("run_id", "ts", "error"))
    out = R.attach_attributes(out, FX.tag_dictionary(spark))
    return finish(R.ordered(out.select("run_id", "ts", "tag_id", "value", "error", "description", "area", "tag_type"), "ts", "tag_id"))


@register("controls_sheet", f"""
WITH {H}, r AS (SELECT * FROM h ORDER BY ts DESC LIMIT 3),
l AS (SELECT ts, 'click' AS tag_id, click AS v FROM r UNION ALL SELECT ts, 'view', view FROM r),
n AS (SELECT *, row_number() OVER (PARTITION BY tag_id ORDER BY ts) AS k FROM l)
SELECT tag_id, {sql_r('max(v) FILTER (WHERE k = 1)')} AS t1, {sql_r('max(v) FILTER (WHERE k = 2)')} AS t2,
       {sql_r('max(v) FILTER (WHERE k = 3)')} AS t3 FROM n GROUP BY tag_id
""")
def controls_sheet(spark, sf_dir):
    """OPT13: controls by time of the latest three runs (their times are the sheet's columns)."""
    from sensorloom.operators import filters as FL
    from sensorloom.operators import optimize as O
    runs = FL.filter_timestamp_optimization(_runs(spark, sf_dir), mode="end", n=3)
    stamps = sorted(r.ts for r in runs.select("ts").collect())
    rows = runs.select("ts", F.explode(F.array(*[F.struct(F.lit(c).alias("tag_id"), F.col(c).alias("suggested"))
                                                 for c in ("click", "view")])).alias("c")).select("ts", "c.*")
    sheet = O.controls_sheet(rows, stamps)
    return finish(sheet.select("tag_id", *[F.col(f"`{t}`").alias(f"t{i + 1}") for i, t in enumerate(stamps)]))


@register("aligned_tables", f"""
WITH {H}, a AS (SELECT ts, click FROM h WHERE ts < TIMESTAMP '2024-01-20 00:00:00'),
b AS (SELECT ts, view FROM h WHERE ts >= TIMESTAMP '2024-01-10 00:00:00')
SELECT ts, {sql_r('click')} AS click, {sql_r('view')} AS view FROM a FULL JOIN b USING (ts)
""")
def aligned_tables(spark, sf_dir):
    """JOI15: two overlapping spans side by side on their index."""
    h = FX.hourly_wide(spark, sf_dir)
    a = h.where(F.col("ts") < F.lit(datetime(2024, 1, 20)).cast("timestamp_ntz")).select("ts", "click")
    b = h.where(F.col("ts") >= F.lit(datetime(2024, 1, 10)).cast("timestamp_ntz")).select("ts", "view")
    return finish(R.aligned(a, b))


@register("tail_and_append", f"""
WITH {H}, k AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY ts DESC) AS r FROM h) WHERE r > 5),
n AS (SELECT ts, click + 1000 AS click FROM h WHERE ts >= {CUT_SQL}),
u AS (SELECT ts, click FROM k WHERE ts NOT IN (SELECT ts FROM n) UNION ALL SELECT * FROM n),
d AS (SELECT count(*) AS descents FROM (SELECT ts, lag(ts) OVER (ORDER BY event_id) AS p FROM events) WHERE ts < p)
SELECT ts, {sql_r('click')} AS click, descents FROM u, d
""")
def tail_and_append(spark, sf_dir):
    """LIM2 without the last five rows, SET2 append and keep the later, SRT1 rows out of order in the event log."""
    h = FX.hourly_wide(spark, sf_dir).select("ts", "click")
    new = h.where(F.col("ts") >= F.lit(CUT).cast("timestamp_ntz")).withColumn("click", F.col("click") + 1000.0)
    ev = FX.table(spark, sf_dir, "events").select("event_id", "ts")
    low = ev.agg(F.min("event_id")).first()[0] or 0
    ev = ev.select(F.lit(0).alias("k"), (F.col("event_id") - low).alias("pos"), "ts")
    n = R.descents(ev, ["k"], "pos").count()
    return finish(R.append_keep_last(R.drop_last_rows(h, 5), new, ["ts"]).withColumn("descents", F.lit(n)))


@register("uplift_summary", f"""
WITH {H}, l AS (SELECT 'click' AS metric, click AS v FROM h UNION ALL SELECT 'gap', click - view FROM h)
SELECT metric, count(v) AS n, {sql_r('avg(v)')} AS mean, {sql_r('stddev_samp(v)')} AS std, {sql_r('min(v)')} AS min,
       {sql_r('quantile_cont(v, 0.25)')} AS p25, {sql_r('quantile_cont(v, 0.5)')} AS median, {sql_r('quantile_cont(v, 0.75)')} AS p75,
       {sql_r('max(v)')} AS max FROM l GROUP BY metric
""")
def uplift_summary(spark, sf_dir):
    """AGG16: mean, median and description of a value and a difference."""
    h = FX.hourly_wide(spark, sf_dir).select("click", (F.col("click") - F.col("view")).alias("gap"))
    return finish(R.uplift_summary(h, ["click", "gap"]))


@register("mean_ratio_screen", f"""
WITH {SQL_TEN_LONG}, m AS (SELECT tag, avg(value) FILTER (WHERE ts < {CUT_SQL}) AS b, avg(value) FILTER (WHERE ts >= {CUT_SQL}) AS a FROM ten_long GROUP BY tag)
SELECT tag, {sql_r('b')} AS mean_before, {sql_r('a')} AS mean_after, {sql_r('b / a')} AS ratio, NOT (b / a BETWEEN 0.9 AND 1.1) AS drifted FROM m
""")
def mean_ratio_screen(spark, sf_dir):
    """AGG19: drift of each tag's mean over a date, outside 0.9 to 1.1."""
    return finish(R.mean_ratio_screen(FX.ten_minute_grid_long(spark, sf_dir).select("tag", "ts", "value"), CUT))


def _scores(y: str) -> str:
    return f"""{sql_r('avg(abs(y - yhat))')} AS mae, {sql_r('sqrt(avg((y - yhat) * (y - yhat)))')} AS rmse, {sql_r('avg((y - yhat) * (y - yhat))')} AS mse,
  {sql_r('100.0 * avg(CASE WHEN y <> 0 THEN abs(y - yhat) / y END)')} AS mape, {sql_r('1.0 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(y))')} AS r2,
  {sql_r('1.0 - var_pop(y - yhat) / var_pop(y)')} AS var_score, {sql_r('avg(y)')} AS mean_true, {sql_r('avg(yhat)')} AS mean_pred, {sql_r('stddev_samp(y)')} AS std_true"""


@register("split_scores", f"""
WITH {H}, tr AS (SELECT ts, click, view, purchase FROM h WHERE ts < {CUT_SQL} AND purchase IS NOT NULL),
q AS (SELECT quantile_cont(purchase, 0.1) AS q FROM tr),
te AS (SELECT ts, click, view, purchase FROM h WHERE ts >= TIMESTAMP '2024-01-12 00:00:00' AND purchase IS NOT NULL),
t2 AS (SELECT 'train' AS split, tr.* FROM tr, q WHERE purchase > q AND (ts BETWEEN TIMESTAMP '2024-01-02 00:00:00' AND TIMESTAMP '2024-01-06 00:00:00'
        OR ts BETWEEN TIMESTAMP '2024-01-07 00:00:00' AND TIMESTAMP '2024-01-31 00:00:00') AND ts NOT IN (SELECT ts FROM te)),
a AS (SELECT * FROM t2 UNION ALL SELECT 'test', te.* FROM te),
l AS (SELECT split, 'purchase' AS target, purchase AS y, click AS yhat FROM a UNION ALL SELECT split, 'click', click, view FROM a),
s AS (SELECT * FROM l WHERE y IS NOT NULL AND yhat IS NOT NULL)
SELECT split, target, {_scores('y')} FROM s GROUP BY split, target
""")
def split_scores(spark, sf_dir):
    """ML3 (with FLT14, FLT15, SET2) and ML11: scores of two targets by split."""
    h = FX.hourly_wide(spark, sf_dir)
    at = lambda *d: F.lit(datetime(*d)).cast("timestamp_ntz")
    rows = R.split_xy(h.where(F.col("ts") < at(2024, 1, 16)), h.where(F.col("ts") >= at(2024, 1, 12)), ["click", "view"], "purchase",
                      own_quantile=0.1, train_ranges=((datetime(2024, 1, 2), datetime(2024, 1, 6)), (datetime(2024, 1, 7), datetime(2024, 1, 31))))
    return finish(R.score_splits(rows, {"purchase": "click", "click": "view"}))


@register("qq_points", f"""
WITH {SQL_TEN_LONG}, v AS (SELECT tag, value, count(*) AS n FROM ten_long WHERE value IS NOT NULL GROUP BY tag, value),
c AS (SELECT tag, value, n, (sum(n) OVER (PARTITION BY tag ORDER BY value) - n * CAST(0.5 AS DOUBLE)) / sum(n) OVER (PARTITION BY tag) AS p FROM v)
SELECT tag, {sql_r('value')} AS value, n, {sql_r('p')} AS p, {sql_r(R.normal_quantile_sql('p'))} AS theoretical FROM c
""")
def qq_points(spark, sf_dir):
    """ML12: observed values against normal quantiles, per tag."""
    return finish(R.qq_points(FX.ten_minute_grid_long(spark, sf_dir).select("tag", "value"), ["tag"], "value"))


# mill constants on the scale of the fixture's sensors
MILL = {"k1": 36.0, "k2": 3.28, "k3": 17.0, "jc_ideal": 30.0, "Jfill": 1.0, "k6": 76.6, "k7": 0.238, "k8": 1.03, "k9": 100.0, "min_vel": 10.0,
        "min_sol": 5.0, "max_sol": 95.0, "min_pres": 5.0, "max_pres": 95.0, "min_pot": 10.0, "k10": 2.8, "k11": 7.75, "min_jb": -50.0,
        "k12": 3.5, "k13": 40.0, "k14": 180.0, "k15": 1.341, "k16": 20.0, "k17": 0.4, "k18": 0.6}
MILL_TAGS = {"velocidad": "click", "presion": "view", "presion_hl": "error", "cp": "purchase", "potencia": "signup"}


def _mill_sql() -> str:
    k = MILL
    d, ln = k["k1"] / k["k2"] * k["k2"], k["k3"] / k["k2"] * k["k2"]
    factor = k["k7"] * d ** k["k12"] * ln * math.sin(k["k13"] / k["k14"] * math.pi)
    fill = ", ".join(f"last_value({c} IGNORE NULLS) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING) AS f_{c}" for c in MILL_TAGS.values())
    steps, last, names = [], "f", []
    num = lambda v: f"CAST({v!r} AS DOUBLE)"
    for i, slope in enumerate((0.33, 1.2)):
        x = {n: (c if i == 0 else f"f_{c}") for n, c in MILL_TAGS.items()}
        share = f"(jc{i} / {num(k['k9'])})"
        steel = num(k["k11"] - k["k10"])
        name = f"ma_m_jc_{str(slope).replace('.', '_')}"
        steps.append(f"""a{i} AS (SELECT *, {num(slope)} * {x['presion']} + ({num(k['jc_ideal'])} - {num(slope)} * {x['presion_hl']}) AS jc{i},
  1 / ({x['cp']} / {num(k['k10'])} / {num(k['k9'])} + (1 - {x['cp']} / {num(k['k9'])})) AS pulp{i},
  {x['velocidad']} / {num(k['k6'])} * {num(math.sqrt(d))} * {num(k['k9'])} AS nc{i} FROM {last}),
b{i} AS (SELECT *, {num(factor)} * {share} * (1 - {num(k['k8'])} * {share}) * nc{i} / {num(k['k9'])} AS raw{i} FROM a{i}),
c{i} AS (SELECT *, CASE WHEN raw{i} > {num(k['k9'])} THEN raw{i} END AS load{i} FROM b{i}),
e{i} AS (SELECT *, ({share} * ({x['potencia']} * {num(k['k15'])} * {num(k['k16'])} / load{i}) - pulp{i} * ({share} * {num(k['k17'])}) * {num(k['Jfill'])})
  / {num(k['k18'])} / {steel} - {num(k['k10'])} * {share} / {steel} AS jb{i} FROM c{i}),
g{i} AS (SELECT *, CASE WHEN {x['cp']} BETWEEN {k['min_sol']} AND {k['max_sol']} AND {x['potencia']} >= {k['min_pot']} AND {x['velocidad']} >= {k['min_vel']}
  AND {x['presion']} BETWEEN {k['min_pres']} AND {k['max_pres']} AND jb{i} > {k['min_jb']} THEN jb{i} END AS {name}_jb, jc{i} AS {name}_jc FROM e{i})""")
        last = f"g{i}"
        names += [f"{name}_jb", f"{name}_jc"]
    out = ", ".join(sql_r(f"last_value({n} IGNORE NULLS) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING)") + f" AS {n}" for n in names)
    steps = ",\n".join(steps)
    return f"WITH {SQL_TEN_MIN}, f AS (SELECT *, {fill} FROM ten),\n{steps}\nSELECT ts, pos, {out} FROM {last}"


@register("mill_filling", _mill_sql())
def mill_filling(spark, sf_dir):
    """FEA16 with CLN9: ball and total filling of a mill for two slopes, on 10-minute rows."""
    out = R.mill_filling(FX.ten_minute_wide(spark, sf_dir), MILL_TAGS, MILL, [0.33, 1.2], "ma", bucket_rows=1024)
    return finish(out.drop(*MILL_TAGS.values()))


@register("relining_stamps", """
WITH t AS (SELECT o_custkey AS name, o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN o_orderkey % 7 = 0 THEN 'soon'
                  ELSE strftime(o_orderdate, '%d/%m/%Y') END AS txt, o_orderdate FROM orders),
l AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY o_orderkey DESC) AS r FROM t)
SELECT name, txt, CASE WHEN txt <> 'soon' THEN CAST(o_orderdate AS TIMESTAMP) END AS stamp FROM l WHERE r = 1
""")
def relining_stamps(spark, sf_dir):
    """FEA26: last record per name, its time text parsed by the first format that fits."""
    o = FX.table(spark, sf_dir, "orders")
    txt = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(F.col("o_orderkey") % 7 == 0, "soon").otherwise(
        F.date_format("o_orderdate", "dd/MM/yyyy"))
    rows = o.select(F.col("o_custkey").alias("name"), "o_orderkey", txt.alias("txt"))
    return finish(R.relining_stamps(rows, "name", "txt", "o_orderkey", ["yyyy-MM-dd", "dd/MM/yyyy"]).select("name", "txt", "stamp"))


def _chain_sql() -> str:
    f = s_cut("feed", 0.5, 2.0)
    tw = "(0.0 + t1 * 0.5 + t2 * 0.5)"
    rec = s_cut(s_div(f"conc * ({f} - {tw})", f"{f} * (conc - {tw})"), 0, 1)
    cells = ", ".join(f"{v} AS {k}" for k, v in CELLS_SQL.items())
    return f"""WITH m AS (SELECT l_orderkey, l_linenumber, {cells}, 0.5 + 15.0 * l_tax AS feed, 20.0 + l_quantity / 5.0 AS conc FROM lineitem),
a AS (SELECT *, 0.5 * c1 + 10.0 AS p1, 2.0 * c2 AS p2 FROM m),
b AS (SELECT *, {s_div('p1', 'p2')} AS ratio, {s_rsum(['p1', 'p2'])} AS total FROM a),
c AS (SELECT *, 0.05 + total / 200.0 AS x1, 0.01 * coalesce(ratio, 1.0) + 0.1 AS x2 FROM b),
d AS (SELECT *, {s_cut('x1', 0.02, 0.4)} AS t1, {s_cut('x2', 0.02, 0.4)} AS t2 FROM c)
SELECT l_orderkey, l_linenumber, {sql_r('total')} AS tph_total, {sql_r(f"total * ({rec}) * feed / 100.0")} AS chain_cuf FROM d"""


@register("fine_copper_chain", _chain_sql())
def fine_copper_chain(spark, sf_dir):
    """OPT4: throughput models, then tails models on the updated row, then recovery and fine copper."""
    out = R.fine_copper_chain(
        _metallurgy(spark, sf_dir).drop("tails", "tails2", "tph"),
        {"p1": lambda d: 0.5 * F.col("c1") + 10.0, "p2": lambda d: 2.0 * F.col("c2")},
        {"x1": lambda d: 0.05 + F.col("tph_total") / 200.0, "x2": lambda d: 0.01 * F.coalesce("ratio", F.lit(1.0)) + 0.1},
        "conc", "feed", [0.5, 0.5], ratio_col="ratio")
    return finish(out.select("l_orderkey", "l_linenumber", "tph_total", "chain_cuf"))


@register("attribution", f"""
WITH {H}, b AS (SELECT avg(click) AS c, avg(view) AS v, avg(error) AS e FROM h),
r AS (SELECT ts, click, view, error FROM h WHERE click IS NOT NULL AND view IS NOT NULL AND error IS NOT NULL),
l AS (SELECT ts, 'click' AS feature, (click - c) * 0.03 * 50.0 AS x FROM r, b
      UNION ALL SELECT ts, 'error', 2.0 * (error - e) FROM r, b
      UNION ALL SELECT ts, 'view', 0.01 * (view * view - v * v) FROM r, b)
SELECT ts, feature, {sql_r('x')} AS contribution, true AS adds_up FROM l
""")
def attribution(spark, sf_dir):
    """ML13: contributions of an additive model are each feature's own term against the background;
    the row sums are the prediction less the background's."""
    feats = ["click", "view", "error"]
    h = FX.hourly_wide(spark, sf_dir).select("ts", *feats)
    mean = h.agg(*[F.avg(f).alias(f) for f in feats]).first().asDict()
    model = lambda d: d.withColumn("prediction", F.col("click") * 0.03 * 50.0 + 2.0 * F.col("error") + 0.01 * F.col("view") * F.col("view"))
    rows = h.na.drop()
    out = A.permutation_attribution(rows, ["ts"], feats, model, mean)
    base = spark.range(1).select(*[F.lit(mean[f]).alias(f) for f in feats])
    start = model(base).first()["prediction"] if all(v is not None for v in mean.values()) else 0.0
    sums = out.groupBy("ts").agg(F.sum("contribution").alias("s")).join(model(rows).select("ts", "prediction"), "ts")
    sums = sums.select("ts", (F.abs(F.col("s") - (F.col("prediction") - start)) < 1e-6).alias("adds_up"))
    return finish(out.drop("std_error").join(sums, "ts"))


def _recovery_sql() -> str:
    rec = lambda t: s_div(f"(feed - {t}) * conc", f"(conc - {t}) * feed")
    e = "(y - p)"
    return f"""WITH {_MET_SQL}, r AS (SELECT CASE WHEN l_linenumber <= 3 THEN 'train' ELSE 'test' END AS split, {rec('tails')} AS y,
  {rec('tails2')} AS p1, {rec("(tails * 0.9 + (tails2 - tails) * 0.5)")} AS p2 FROM m),
l AS (SELECT 'level' AS kind, split, y, p1 AS p FROM r UNION ALL SELECT 'change', split, y, p2 FROM r)
SELECT kind, split, {sql_r(f'avg(abs{e})')} AS mae, {sql_r(f'sqrt(avg({e} * {e}))')} AS rmse, {sql_r('avg(y)')} AS mean_true, {sql_r('avg(p)')} AS mean_pred,
  {sql_r(f'1.0 - var_pop{e} / var_pop(y)')} AS var_score, {sql_r('stddev_samp(y)')} AS std_true
FROM l WHERE y IS NOT NULL AND p IS NOT NULL GROUP BY 1, 2"""


@register("recovery_scores", _recovery_sql())
def recovery_scores(spark, sf_dir):
    """ML11: scores of the recovery that follows from predicted tails, given as a level and as a change."""
    m = _metallurgy(spark, sf_dir)
    actual = safe_div((F.col("feed") - F.col("tails")) * F.col("conc"), (F.col("conc") - F.col("tails")) * F.col("feed"))
    m = m.withColumns({"split": F.when(F.col("l_linenumber") <= 3, "train").otherwise("test"), "recovery": actual,
                       "lag1": F.col("tails") * 0.9, "change": (F.col("tails2") - F.col("tails")) * 0.5})
    parts = [R.score_recovery(m, "recovery", "conc", "feed", *how).withColumn("kind", F.lit(kind)) for kind, how in (("level", ("tails2",)), ("change", ("change", "lag1")))]
    return finish(parts[0].unionByName(parts[1]).select("kind", "split", "mae", "rmse", "mean_true", "mean_pred", "var_score", "std_true"))
