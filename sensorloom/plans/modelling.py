"""Registered queries: splits, metrics, fits (§2.12 ML rows)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from sensorloom.operators import gram as G
from sensorloom.operators import ml as M
from sensorloom.operators import windows as W
from sensorloom.plans.common import SQL_HOURLY, finish, register, round_digits, sql_r
from sensorloom.sources import fixtures as FX

FEATURES = ["l_quantity", "l_discount", "l_tax"]
Y_SQL = "3.0 * l_quantity - 40.0 * l_discount + 25.0 * l_tax + ((l_partkey % 7) - 3) / 10.0"
YHAT_SQL = "3.0 * l_quantity - 40.0 * l_discount + 25.0 * l_tax"


def _metrics_sql(src: str, y: str, yhat: str, keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    gb = f"GROUP BY {keys}" if keys else ""
    return f"""
SELECT {k}{sql_r(f'avg(abs({y} - {yhat}))')} AS mae,
  {sql_r(f'sqrt(avg(({y} - {yhat}) * ({y} - {yhat})))')} AS rmse,
  {sql_r(f'avg(({y} - {yhat}) * ({y} - {yhat}))')} AS mse,
  {sql_r(f'100.0 * avg(CASE WHEN {y} <> 0 THEN abs({y} - {yhat}) / {y} END)')} AS mape,
  {sql_r(f'1.0 - sum(({y} - {yhat}) * ({y} - {yhat})) / (var_pop({y}) * count({y}))')} AS r2,
  {sql_r(f'1.0 - var_pop({y} - {yhat}) / var_pop({y})')} AS var_score,
  {sql_r(f'avg({y})')} AS mean_true, {sql_r(f'avg({yhat})')} AS mean_pred
FROM {src} {gb}"""


@register("regression_metrics", f"""
WITH r AS (SELECT l_returnflag, {Y_SQL} AS y, {YHAT_SQL} AS yhat FROM lineitem)
{_metrics_sql('r', 'y', 'yhat', 'l_returnflag')}
""")
def regression_metrics(spark, sf_dir):
    """AGG13 per return flag for the closed-form model ``3q − 40d + 25t``."""
    li = FX.table(spark, sf_dir, "lineitem")
    r = FX.regression_table(spark, sf_dir).select("y", *FEATURES)
    r = li.select("l_returnflag", *FEATURES, "l_partkey").select(
        "l_returnflag",
        (F.lit(3.0) * F.col("l_quantity") - F.lit(40.0) * F.col("l_discount")
         + F.lit(25.0) * F.col("l_tax")
         + ((F.col("l_partkey") % 7) - F.lit(3)).cast("double") / F.lit(10.0)).alias("y"),
        (F.lit(3.0) * F.col("l_quantity") - F.lit(40.0) * F.col("l_discount")
         + F.lit(25.0) * F.col("l_tax")).alias("yhat"))
    return finish(M.regression_metrics(r, "y", "yhat", ["l_returnflag"]))


@register("baseline_metrics", f"""
WITH h AS ({SQL_HOURLY}),
p AS (SELECT ts, purchase, lag(purchase, 1) OVER (ORDER BY ts) AS prev FROM h),
tr AS (SELECT avg(purchase) AS m FROM h WHERE ts <= TIMESTAMP '2024-01-20 00:00:00'),
te AS (SELECT p.purchase AS y, tr.m AS pred_mean, p.prev AS pred_prev FROM p, tr
       WHERE p.ts > TIMESTAMP '2024-01-20 00:00:00'),
a AS (SELECT 'mean' AS baseline, y, pred_mean AS yhat FROM te
      UNION ALL SELECT 'previous', y, pred_prev FROM te WHERE pred_prev IS NOT NULL AND y IS NOT NULL)
{_metrics_sql('a', 'y', 'yhat', 'baseline')}
""")
def baseline_metrics(spark, sf_dir):
    """ML1 date split + ML14 mean / previous-value baselines + AGG13."""
    h = FX.hourly_wide(spark, sf_dir).select("ts", "purchase").withColumn("_k", F.lit(0))
    h = W.dense_index(h, ["_k"], "ts")
    h = W.positional(h, ["_k"], "pos", lambda w: {"prev": F.lag("purchase", 1).over(w)}, back=1,
                     bucket_rows=256)
    sp = M.split_by_date(h, "ts", datetime(2024, 1, 20))
    m = sp["train"].agg(F.avg("purchase")).first()[0]
    te = M.baseline_predictions(sp["test"], "purchase", m, "prev")
    a = te.select(F.lit("mean").alias("baseline"), F.col("purchase").alias("y"),
                  F.col("pred_mean").alias("yhat")).unionByName(
        te.where(F.col("pred_prev").isNotNull() & F.col("purchase").isNotNull()).select(
            F.lit("previous").alias("baseline"), F.col("purchase").alias("y"),
            F.col("pred_prev").alias("yhat")))
    return finish(M.regression_metrics(a, "y", "yhat", ["baseline"]))


@register("split_fraction", f"""
WITH h AS ({SQL_HOURLY}), n AS (SELECT count(*) AS n FROM h),
r AS (SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS pos FROM h)
SELECT CASE WHEN pos < CAST(floor((SELECT n FROM n) * CAST(0.7 AS DOUBLE)) AS BIGINT) THEN 'train' ELSE 'test' END AS part,
       count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts
FROM r GROUP BY 1
""")
def split_fraction(spark, sf_dir):
    """ML2: time-ordered fraction split (first 70 % of rows train)."""
    sp = M.split_by_frac(FX.hourly_wide(spark, sf_dir), "ts", 0.7)
    out = None
    for part, d in sp.items():
        x = d.agg(F.lit(part).alias("part"), F.count(F.lit(1)).alias("n_rows"),
                  F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
        out = x if out is None else out.unionByName(x)
    return finish(out)


@register("time_folds", """
WITH r AS (SELECT l_shipdate, row_number() OVER (ORDER BY l_shipdate) - 1 AS pos,
                  count(*) OVER () AS n FROM lineitem),
f AS (SELECT l_shipdate, CASE WHEN pos < n - 5 * (n // 6) THEN -1
                              ELSE CAST(floor((pos - (n - 5 * (n // 6))) / (n // 6)) AS INTEGER) END AS fold
      FROM r)
SELECT fold, count(*) AS n_rows, min(l_shipdate) AS first_ts, max(l_shipdate) AS last_ts
FROM f GROUP BY fold
""")
def time_folds(spark, sf_dir):
    """ML5 folds: expanding time split into 5 test blocks (TimeSeriesSplit blocks)."""
    r = FX.regression_table(spark, sf_dir).select("l_shipdate")
    f = M.time_folds(r, "l_shipdate", 5)
    return finish(f.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"),
                                        F.min("l_shipdate").alias("first_ts"),
                                        F.max("l_shipdate").alias("last_ts")))


_CORR_COLS = FEATURES + ["y"]


@register("correlation_matrix", f"""
WITH r AS (SELECT l_quantity, l_discount, l_tax, {Y_SQL} AS y FROM lineitem)
{" UNION ALL ".join(f"SELECT '{a}' AS var_a, '{b}' AS var_b, {sql_r(f'corr({a}, {b})')} AS corr FROM r"
                    for a in _CORR_COLS for b in _CORR_COLS)}
""")
def correlation_matrix(spark, sf_dir):
    """ML16: Pearson correlation of features and target."""
    return finish(G.correlation(FX.regression_table(spark, sf_dir), _CORR_COLS))


@register("model_fit_importance")
def model_fit_importance(spark, sf_dir):
    """ML4/ML7/ML9/ML12: GBT pipeline fit, predictions, metrics and importances."""
    r = FX.regression_table(spark, sf_dir)
    sp = M.split_by_date(r, "l_shipdate", datetime(2000, 1, 1))
    model = M.fit(sp["train"], FEATURES, "y", M.load_regressor("gbt", maxIter=10, maxDepth=4, seed=7))
    pred = M.residuals(M.predict(model, sp["test"]), "y", "prediction")
    met = M.regression_metrics(pred, "y", "prediction").first()
    imp = M.feature_importance(model, FEATURES, spark)
    return finish(imp.select("feature", "importance", F.lit(met["r2"]).alias("test_r2"),
                             F.lit(met["rmse"]).alias("test_rmse")))


@register("tuned_models_per_unit")
def tuned_models_per_unit(spark, sf_dir):
    """ML5/ML6 random search with expanding time folds on the hourly table, and
    ML17 one linear model per return-flag unit with per-unit metrics."""
    h = FX.hourly_wide(spark, sf_dir).na.drop(subset=["purchase"])
    sensors = ["click", "error", "signup", "view"]
    # the five settings of the search; stepSize and maxDepth have one value there as here
    space = {"maxIter": [19, 25], "maxDepth": [3], "stepSize": [0.1], "minInstancesPerNode": [1, 55], "subsamplingRate": [0.7]}
    best, res = M.tune(h, "ts", sensors, "purchase", "gbt", space)
    winner = M.regression_metrics(M.predict(best, h), "purchase", "prediction").select(F.lit("winner_refitted").alias("unit"), "r2", "rmse")
    li = FX.table(spark, sf_dir, "lineitem")
    r = li.select("l_returnflag", *FEATURES,
                  (F.lit(3.0) * F.col("l_quantity") - F.lit(40.0) * F.col("l_discount")
                   + F.lit(25.0) * F.col("l_tax")
                   + ((F.col("l_partkey") % 7) - F.lit(3)).cast("double") / F.lit(10.0)).alias("y"))
    units = sorted(u[0] for u in r.select("l_returnflag").distinct().collect() if u[0] is not None)
    models = M.model_per_unit(r, "l_returnflag", units, FEATURES, "y", "linear", threads=3)
    out = None
    for u, m in models.items():
        met = M.regression_metrics(M.predict(m, r.where(F.col("l_returnflag") == u)), "y", "prediction")
        met = met.select(F.lit(u).alias("unit"), "r2", "rmse")
        out = met if out is None else out.unionByName(met)
    tuned = res.groupBy("draw", "params").agg(F.avg("rmse").alias("rmse")).select(
        F.concat(F.lit("draw "), "params").alias("unit"), F.lit(None).cast("double").alias("r2"), "rmse")
    return finish(out.unionByName(tuned).unionByName(winner))


WIDE, GAP = 60, 7


def _wide_sql() -> str:
    return f"""WITH w AS (SELECT vec_id, k, CASE WHEN (vec_id + k) % {GAP} <> 0 THEN CAST(e AS DOUBLE) + k END AS x
  FROM (SELECT vec_id, unnest(range(0, {WIDE})) AS k, unnest(embedding[1:{WIDE}]) AS e FROM embeddings))
SELECT 'e' || a.k AS var_a, 'e' || b.k AS var_b, {sql_r("corr(a.x, b.x)")} AS corr
FROM w a JOIN w b ON a.vec_id = b.vec_id WHERE a.x IS NOT NULL AND b.x IS NOT NULL GROUP BY 1, 2"""


@register("wide_correlation", _wide_sql())
def wide_correlation(spark, sf_dir):
    """ML16: all pairs of 60 columns with gaps, each over its own complete rows."""
    cells = [F.expr(f"CASE WHEN (vec_id + {k}) % {GAP} <> 0 THEN CAST(embedding[{k}] AS DOUBLE) + {k} END").alias(f"e{k}") for k in range(WIDE)]
    return finish(G.correlation(FX.table(spark, sf_dir, "embeddings").select(*cells), [f"e{k}" for k in range(WIDE)]))


def _units_sql() -> str:
    pairs = {"11": ("x1", "x1"), "12": ("x1", "x2"), "22": ("x2", "x2"), "1y": ("x1", "y"), "2y": ("x2", "y"), "yy": ("y", "y")}
    sums = ", ".join(f"sum({c}) AS s_{c}" for c in ("x1", "x2", "y")) + ", " + ", ".join(f"sum({a} * {b}) AS p{n}" for n, (a, b) in pairs.items())
    names = ["n", "s_x1", "s_x2", "s_y", *[f"p{n}" for n in pairs]]
    prefix = ", ".join(f"sum({c}) OVER (PARTITION BY unit ORDER BY fold ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS t_{c}" for c in names)
    around = lambda p, a, b: f"({p} - {a} * {b} / t_n)"
    c11, c12, c22, c1y, c2y = (around(p, a, b) for p, a, b in (("t_p11", "t_s_x1", "t_s_x1"), ("t_p12", "t_s_x1", "t_s_x2"), ("t_p22", "t_s_x2", "t_s_x2"),
                                                              ("t_p1y", "t_s_x1", "t_s_y"), ("t_p2y", "t_s_x2", "t_s_y")))
    sse = ("(pyy - 2 * (b0 * s_y + b1 * p1y + b2 * p2y) + b0 * b0 * n + b1 * b1 * p11 + b2 * b2 * p22"
           " + 2 * (b0 * b1 * s_x1 + b0 * b2 * s_x2 + b1 * b2 * p12))")
    return f"""WITH r AS (SELECT l_suppkey AS unit, l_orderkey * 10 + l_linenumber AS o, l_quantity AS x1, l_discount * 100.0 AS x2,
  3.0 * l_quantity - 40.0 * l_discount + ((l_partkey % 7) - 3) / 10.0 + (l_suppkey % 5) AS y FROM lineitem),
p AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY o) - 1 AS pos, count(*) OVER (PARTITION BY unit) AS m
  FROM (SELECT unit, o, min(x1) AS x1, min(x2) AS x2, min(y) AS y FROM r GROUP BY 1, 2)),
f AS (SELECT unit, x1, x2, y, CASE WHEN m // 6 = 0 OR pos < m - 5 * (m // 6) THEN -1 ELSE (pos - (m - 5 * (m // 6))) // (m // 6) END AS fold FROM p),
g AS (SELECT unit, fold, count(*)::DOUBLE AS n, {sums} FROM f GROUP BY 1, 2),
t AS (SELECT *, {prefix} FROM g),
a AS (SELECT unit, CAST(fold AS INTEGER) AS fold, {", ".join(names)}, {", ".join("t_" + c for c in names)} FROM t WHERE fold >= 0
  UNION ALL SELECT unit, NULL, {", ".join(f"sum({c})" for c in names)}, {", ".join(f"sum({c})" for c in names)} FROM g GROUP BY unit),
b AS (SELECT *, ({c22} * {c1y} - {c12} * {c2y}) / ({c11} * {c22} - {c12} * {c12}) AS b1, ({c11} * {c2y} - {c12} * {c1y}) / ({c11} * {c22} - {c12} * {c12}) AS b2 FROM a),
d AS (SELECT *, (t_s_y - b1 * t_s_x1 - b2 * t_s_x2) / t_n AS b0 FROM b)
SELECT unit, fold, CAST(t_n AS BIGINT) AS n_train, CAST(n AS BIGINT) AS n_test, {sql_r("b0", 4)} AS b0, {sql_r("b1", 4)} AS b1, {sql_r("b2", 4)} AS b2,
  {sql_r(f"sqrt(greatest(0.0, {sse}) / n)", 3)} AS rmse FROM d"""


@register("linear_units", _units_sql())
def linear_units(spark, sf_dir):
    """ML17: a linear model per supplier and time block in one scan, solved and scored from sums of products."""
    li = FX.table(spark, sf_dir, "lineitem")
    rows = li.select(F.col("l_suppkey").alias("unit"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("o"), F.col("l_quantity").alias("x1"),
                     (F.col("l_discount") * 100.0).alias("x2"), F.expr("3.0D * l_quantity - 40.0D * l_discount + ((l_partkey % 7) - 3) / 10.0D + (l_suppkey % 5)").alias("y"))
    out = G.linear_per_unit(rows.groupBy("unit", "o").agg(*[F.min(c).alias(c) for c in ("x1", "x2", "y")]), "unit", "o", ["x1", "x2"], "y")
    b = F.col("coefficients")
    return out.select("unit", "fold", "n_train", "n_test", *[round_digits(b[k], 4).alias(f"b{k}") for k in range(3)], round_digits(F.col("rmse"), 3).alias("rmse"))
