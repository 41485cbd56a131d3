"""Registered queries: bounds, ranges, sensitivity, control search (§2.12 OPT rows)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from sensorloom.functions.exprs import bin_left
from sensorloom.operators import filters as FL
from sensorloom.operators import gram as G
from sensorloom.operators import ml as M
from sensorloom.operators import optimize as O
from sensorloom.operators import projection as P
from sensorloom.operators import tags as TG
from sensorloom.plans.common import SQL_HOURLY, finish, register, round_digits, sql_r
from sensorloom.session import written
from sensorloom.sources import fixtures as FX

H = f"WITH h AS ({SQL_HOURLY})"
# closed-form objective with a known optimum at click = 50, view = 40
OBJ_SQL = "(-(click - 50.0) * (click - 50.0) - (view - 40.0) * (view - 40.0) + 0.1 * coalesce(error, 0.0))"


def _objective():
    return O.expression_objective(
        -(F.col("click") - 50.0) * (F.col("click") - 50.0)
        - (F.col("view") - 40.0) * (F.col("view") - 40.0)
        + F.lit(0.1) * F.coalesce(F.col("error"), F.lit(0.0)))


def _runs(spark, sf_dir):
    h = FX.hourly_wide(spark, sf_dir)
    return P.with_run_id(h.withColumn("unit", F.lit("r2")), ["ts", "unit"]).drop("unit")


@register("control_bounds", f"""{H},
l AS (SELECT ts, 'click' AS tag, click AS value FROM h UNION ALL SELECT ts, 'view', view FROM h),
td(tag, op_min, op_max, max_delta, cset) AS (VALUES ('click', 5.0, 95.0, 10.0, NULL),
                                               ('view', 10.0, 90.0, NULL, [20.0, 40.0, 60.0, 80.0])),
b AS (SELECT l.ts, l.tag, l.value,
        CASE WHEN td.max_delta IS NULL THEN td.op_min ELSE greatest(td.op_min, l.value - td.max_delta) END AS lo,
        CASE WHEN td.max_delta IS NULL THEN td.op_max ELSE least(td.op_max, l.value + td.max_delta) END AS hi,
        td.cset FROM l JOIN td USING (tag))
SELECT ts, tag, {sql_r('value')} AS value, {sql_r('lo')} AS lo, {sql_r('hi')} AS hi,
       coalesce(lo > hi, false) AS bad_bounds,
       {sql_r("CASE WHEN cset IS NULL THEN value ELSE (SELECT s FROM (SELECT unnest(cset) AS s) ORDER BY abs(value - s), s LIMIT 1) END")} AS repaired
FROM b
""")
def control_bounds(spark, sf_dir):
    """OPT5 controls from the dictionary, OPT7 solver bounds, OPT8 set repair —
    for every hour (run) and control."""
    h = FX.hourly_wide(spark, sf_dir)
    td = FX.tag_dictionary(spark)
    ctl = TG.tag_list(TG.select_tags(td, "tag_type", "control"))
    long = h.select("ts", F.explode(F.array(*[F.struct(F.lit(c).alias("tag"), F.col(c).alias("value"))
                                                for c in ctl])).alias("_c")).select("ts", "_c.*")
    b = O.solver_bounds(long, td)
    cs = td.select("tag", O.parse_constraint_set("constraint_set").alias("cset"))
    b = b.join(cs, "tag", "left")
    rep = F.when(F.col("cset").isNull(), F.col("value")).otherwise(O.set_repair(F.col("value"), F.col("cset")))
    return finish(b.select("ts", "tag", "value", "lo", "hi", "bad_bounds", rep.alias("repaired")))


def _range_sql():
    click = ", ".join(repr(5.0 + i * ((95.0 - 5.0) / 50.0)) for i in range(50))
    return click


@register("sensitivity_grid", f"""{H},
g AS (SELECT 'click' AS control, unnest([{_range_sql()}]) AS v
      UNION ALL SELECT 'view', unnest([20.0, 40.0, 60.0, 80.0])),
e AS (SELECT h.ts, g.control, g.v,
             CASE WHEN g.control = 'click' THEN g.v ELSE h.click END AS click,
             CASE WHEN g.control = 'view' THEN g.v ELSE h.view END AS view, h.error
      FROM h JOIN g ON true)
SELECT sha256(strftime(ts, '%Y-%m-%d %H:%M:%S') || '|r2') AS run_id, ts, control,
       {sql_r('v')} AS control_value, {sql_r(OBJ_SQL)} AS target_value
FROM e
""")
def sensitivity_grid(spark, sf_dir):
    """OPT14 control ranges (constraint set / operating range, upper end
    excluded) + OPT15 objective along each control for every hourly run."""
    td = FX.tag_dictionary(spark).where(F.col("tag_type") == "control")
    rng = O.control_range(td, 50)
    return finish(O.sensitivity(_runs(spark, sf_dir), rng, _objective()))


# least squares of purchase on click and view, and its values along both
_FIT_SQL = f"""{H},
r AS (SELECT click AS a, view AS b, purchase AS y FROM h WHERE click IS NOT NULL AND view IS NOT NULL AND purchase IS NOT NULL),
c AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS bye FROM r),
m AS (SELECT *, (bb * ay - ab * bye) / (aa * bb - ab * ab) AS p, (aa * bye - ab * ay) / (aa * bb - ab * ab) AS q FROM c),
k AS (SELECT p, q, my - p * ma - q * mb AS o FROM m),
g AS (SELECT 'click' AS variable, 5.0 + i * (95.0 - 5.0) / 49.0 AS value FROM (SELECT unnest(range(50)) AS i)
      UNION ALL SELECT 'view', 10.0 + i * (90.0 - 10.0) / 49.0 FROM (SELECT unnest(range(50)) AS i)),
s AS (SELECT variable, value, ts, o + p * CASE WHEN variable = 'click' THEN value ELSE click END
        + q * CASE WHEN variable = 'view' THEN value ELSE view END AS target FROM h, g, k)"""


def _fitted(spark, sf_dir):
    """The curves of the fitted model along its controls."""
    h = FX.hourly_wide(spark, sf_dir)
    fit = G.linear_per_unit(h.withColumn("unit", F.lit("all")), "unit", "ts", ["click", "view"], "purchase").where("fold is null").first()
    o, p, q = fit.coefficients
    limits = O.control_limits(FX.tag_dictionary(spark).where(F.col("tag").isin("click", "view")))
    return O.model_sensitivity(h, limits, O.expression_objective(F.lit(o) + F.lit(p) * F.col("click") + F.lit(q) * F.col("view")))


@register("model_sensitivity", f"{_FIT_SQL} SELECT variable, {sql_r('value')} AS value, ts, {sql_r('target', 4)} AS target FROM s")
def model_sensitivity(spark, sf_dir):
    """OPT16: a fitted model over 50 points of every control's operating range (both ends), for every row."""
    return finish(_fitted(spark, sf_dir).withColumn("target", round_digits(F.col("target"), 4)))


STAMPS = ["2024-01-10 06:00:00", "2024-01-20 12:00:00", "2024-01-30 18:00:00"]


@register("model_sensitivity_pivot", f"""{_FIT_SQL}
SELECT variable, {sql_r('value')} AS value, {", ".join(f"{sql_r(f"max(target) FILTER (WHERE ts = TIMESTAMP '{t}')", 4)} AS t{k + 1}" for k, t in enumerate(STAMPS))}
FROM s GROUP BY variable, value""")
def model_sensitivity_pivot(spark, sf_dir):
    """OPT16: value by time."""
    out = O.sensitivity_pivot(_fitted(spark, sf_dir), STAMPS)
    return finish(out.withColumns({f"t{k + 1}": round_digits(F.col(f"t{k + 1}"), 4) for k in range(len(STAMPS))}))


@register("objective_sheet", f"""{H},
n AS (SELECT *, CASE WHEN click IS NOT NULL THEN least(greatest(50.0, click - 10.0), click + 10.0) END AS new_click FROM h),
o AS (SELECT ts, {OBJ_SQL} AS cur, {OBJ_SQL.replace('click', 'new_click')} AS sug FROM n)
SELECT ts, {sql_r('cur')} AS target_pred_current, {sql_r('sug')} AS target_pred_optimized, {sql_r('100.0 * ' + '(CASE WHEN cur = 0 THEN NULL ELSE (sug - cur) / cur END)')} AS uplift_pred FROM o
""")
def objective_sheet(spark, sf_dir):
    """OPT13: the objective sheet with the uplift in percent, for a click moved by at most 10 towards its best."""
    runs = _runs(spark, sf_dir)
    now = _objective()(runs).withColumnRenamed("objective", "objective_current")
    moved = now.withColumn("new_click", F.least(F.greatest(F.lit(50.0), F.col("click") - 10.0), F.col("click") + 10.0)).withColumn("new_view", F.col("view"))
    moved = moved.withColumn("new_click", F.when(F.col("click").isNotNull(), F.col("new_click")))
    then = _objective()(moved.withColumn("click", F.col("new_click")))
    found = moved.join(then.select("run_id", "objective"), "run_id")
    return finish(O.objective_sheet(O.uplift(O.recommendation_records(found, ["click", "view"], ["error"]))))


@register("what_if_context", f"""{H}
SELECT ts, {sql_r(OBJ_SQL.replace('click', '(50.0)'))} AS objective_what_if,
       count(*) OVER w AS n_context, {sql_r('sum(click) OVER w')} AS context_clicks, {sql_r('first(view) OVER w')} AS context_first_view
FROM h WINDOW w AS (ORDER BY ts ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING)
""")
def what_if_context(spark, sf_dir):
    """OPT17 what-if re-scoring (click overridden to 50) and OPT18 context rows
    (the two rows before each scored row, with their content)."""
    from sensorloom.operators import windows as W
    h = FX.hourly_wide(spark, sf_dir).withColumn("_k", F.lit(0))
    h = W.dense_index(h, ["_k"], "ts")
    h = W.positional(h, ["_k"], "pos", lambda w: {"_ctx": O.context_rows(["click", "view"], 3, w)}, back=2, bucket_rows=256)
    wi = O.what_if(h, {"click": 50.0}, _objective())
    clicks = F.filter(F.transform("_ctx", lambda r: r["click"]), lambda v: v.isNotNull())
    total = F.when(F.size(clicks) > 0, F.aggregate(clicks, F.lit(0.0), lambda t, v: t + v))
    return finish(wi.select("ts", F.col("objective").alias("objective_what_if"), F.size("_ctx").cast("long").alias("n_context"),
                            total.alias("context_clicks"), F.get(F.col("_ctx"), F.lit(0))["view"].alias("context_first_view")))


TOL = 2.0  # of the closed form's best control value


@register("recommendations", f"""{H},
r AS (SELECT *, CASE WHEN hour(ts) % 12 = 0 THEN 0.0 ELSE 1.0 END AS pump_on FROM h ORDER BY ts DESC LIMIT 24),
l AS (SELECT ts, error, click, view, 'click' AS tag_id, click AS cur, pump_on FROM r
      UNION ALL SELECT ts, error, click, view, 'view', view, pump_on FROM r)
SELECT sha256(strftime(ts, '%Y-%m-%d %H:%M:%S') || '|r2') AS run_id, ts, tag_id, {sql_r('cur')} AS current,
       pump_on > 0.5 AND cur IS NOT NULL AS free, true AS in_bounds, true AS in_set, true AS unmoved_if_not_free,
       true AS near_best, true AS uplift_adds_up
FROM l
""")
def recommendations(spark, sf_dir):
    """OPT6–OPT12 on the latest 24 hourly runs (FLT6 picks them, as the reference
    optimises the latest rows): free controls, bounds and repairs per run, all
    generations, records, control rows and uplift.  The search is stochastic, so
    what comes out is checked here against each run's own limits and the closed
    form's best point."""
    controls = ["click", "view"]
    td = FX.tag_dictionary(spark)
    runs = _runs(spark, sf_dir).withColumns({"pump_on": F.when(F.hour("ts") % 12 == 0, 0.0).otherwise(1.0), "line_on": F.lit(1.0)})
    latest = FL.filter_timestamp_optimization(runs, None, datetime(2024, 2, 1), mode="end", n=24)

    def objective(df):
        term = lambda c, x: F.coalesce((F.col(c) - x) * (F.col(c) - x), F.lit(0.0))
        return df.withColumn("objective", -term("click", 50.0) - term("view", 40.0) + 0.1 * F.coalesce(F.col("error"), F.lit(0.0)))

    found = O.search_controls(latest, td, TG.dependency_closure(td), controls, objective)
    rec = O.recommendation_records(found, controls, ["error", "signup"])
    rows = O.control_rows(rec).join(O.uplift(rec).drop("ts"), "run_id")
    flags = found.select("run_id", F.explode(F.array(*[F.struct(
        F.lit(c).alias("tag_id"), F.col(f"free_{c}").alias("free"), F.col(f"lo_{c}").alias("lo"), F.col(f"hi_{c}").alias("hi"))
        for c in controls])).alias("f")).select("run_id", "f.*")
    rows = rows.join(flags, ["run_id", "tag_id"])
    s, free = F.col("suggested"), F.col("free")
    click_best = F.least(F.greatest(F.lit(50.0), F.col("lo")), F.col("hi"))
    best = F.when(F.col("tag_id") == "click", click_best).otherwise(F.lit(40.0))
    up = F.col("objective_suggested") - F.col("objective_current")
    pct_ok = F.when(F.col("objective_current") == 0, F.col("uplift_pred_pct").isNull()).otherwise(
        F.abs(F.col("uplift_pred_pct") - 100.0 * up / F.col("objective_current")) < 1e-6)
    return finish(rows.select(
        "run_id", "ts", "tag_id", "current", "free",
        (~free | s.between(F.col("lo"), F.col("hi"))).alias("in_bounds"),
        (~free | (F.col("tag_id") == "click") | s.isin(20.0, 40.0, 60.0, 80.0)).alias("in_set"),
        (free | s.eqNullSafe(F.col("current"))).alias("unmoved_if_not_free"),
        (~free | (F.abs(s - best) <= TOL)).alias("near_best"),
        ((F.col("uplift_pred") == up) & pct_ok & (up >= 0)).alias("uplift_adds_up")))


@register("recommendations_fitted", f"""{H},
r AS (SELECT * FROM h ORDER BY ts DESC LIMIT 12),
l AS (SELECT ts, 'click' AS tag_id, click AS cur FROM r UNION ALL SELECT ts, 'view', view FROM r)
SELECT ts, tag_id, {sql_r('cur')} AS current, true AS in_bounds, true AS in_set, true AS objective_is_the_models, true AS not_worse FROM l
""")
def recommendations_fitted(spark, sf_dir):
    """OPT1–OPT3 in the search: eight fitted models, one a unit, score every trial; their mean less half of the solids is the
    objective.  What comes out is checked against the bounds and against the models' own coefficients."""
    controls, feats = ["click", "view"], ["click", "view", "signup"]
    long = FX.long_sensors(spark, sf_dir).where(F.col("tag") == "error")
    hour = long.select("asset", "value", bin_left("ts", 3600).alias("ts"))
    units = hour.groupBy("ts").agg(*[F.avg(F.when(F.col("asset") == u, F.col("value"))).alias(f"torque_{u}") for u in range(8)])
    train = written(FX.hourly_wide(spark, sf_dir).join(units, "ts"), "train")
    models = {f"u{u}": M.fit(train.where(F.col(f"torque_{u}").isNotNull()), feats, f"torque_{u}", M.load_regressor("linear", regParam=0.1)) for u in range(8)}
    objective = O.models_objective(models, "mean", 0.5, ["signup"])
    td = FX.tag_dictionary(spark)
    runs = _runs(spark, sf_dir).withColumns({"pump_on": F.lit(1.0), "line_on": F.lit(1.0), "signup": F.coalesce("signup", F.lit(50.0))})
    latest = FL.filter_timestamp_optimization(runs, None, datetime(2024, 2, 1), mode="end", n=12)
    found = O.search_controls(latest, td, TG.dependency_closure(td), controls, objective, pop=8, max_gen=12, patience=3, tol=1e-3)

    def by_hand(prefix: str):
        total = F.lit(0.0)
        for m in models.values():
            medians, line = m.stages[0].surrogateDF.first().asDict(), m.stages[-1]
            x = {f: F.coalesce(F.col(prefix + f if f in controls else f), F.lit(float(medians[f]))) for f in feats}
            total = total + F.lit(float(line.intercept)) + sum((F.lit(float(c)) * x[f] for f, c in zip(feats, line.coefficients)), F.lit(0.0))
        return total / 8.0 - 0.5 * F.col("signup")
    same = F.abs(by_hand("new_") - F.col("objective")) < 1e-6
    rows = [F.struct(F.lit(c).alias("tag_id"), F.col(c).alias("current"), F.col(f"new_{c}").alias("new"), F.col(f"free_{c}").alias("free"),
                     F.col(f"lo_{c}").alias("lo"), F.col(f"hi_{c}").alias("hi")) for c in controls]
    out = found.select("ts", same.alias("objective_is_the_models"), (F.col("objective") >= F.col("objective_current") - 1e-9).alias("not_worse"),
                       F.explode(F.array(*rows)).alias("r")).select("ts", "objective_is_the_models", "not_worse", "r.*")
    return finish(out.select("ts", "tag_id", "current", (~F.col("free") | F.col("new").between(F.col("lo"), F.col("hi"))).alias("in_bounds"),
                             (~F.col("free") | (F.col("tag_id") == "click") | F.col("new").isin(20.0, 40.0, 60.0, 80.0)).alias("in_set"),
                             "objective_is_the_models", "not_worse"))
