"""Control search, recommendations and sensitivity (OPT1–OPT18).

Objectives are functions ``DataFrame → DataFrame`` adding an ``objective``
column: a closed-form Column expression, or chained ``PipelineModel.transform``
calls (OPT1–OPT4), so scoring runs on the executors with the models shipped
inside the plan.

The differential-evolution search (OPT9, :func:`search_controls`) keeps a run's
whole population as one array in one row; trials are made inside the row with
seeded hashes, exploded only to be scored, and a run whose best has settled is
frozen (OPT10).  Bounds, repairs and free controls are each run's own (OPT6–OPT8).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from sensorloom.session import written

Objective = Callable[[DataFrame], DataFrame]


# ------------------------------------------------------------------ objectives
def models_objective(models: Mapping[str, object], combine: str = "sum",
                     alpha: float = 0.5, solids: Sequence[str] = ()) -> Objective:
    """OPT1–OPT3: chain model predictions; ``sum`` (throughput) or
    ``mean − α·mean(solids)`` (torque).  All models score a row in one stage, without
    a shuffle; each sees the predictions ``pred_<name>`` of those before it."""
    def obj(df: DataFrame) -> DataFrame:
        d = df
        outs = []
        for name, m in models.items():
            p = m.transform(d)
            d = p.select(*d.columns, F.col("prediction").alias(f"pred_{name}"))
            outs.append(F.col(f"pred_{name}"))
        total = sum(outs, F.lit(0.0))
        if combine == "sum":
            o = total
        else:
            o = total / F.lit(float(len(outs))) - F.lit(alpha) * (
                sum((F.col(s) for s in solids), F.lit(0.0)) / F.lit(float(max(1, len(solids)))))
        return d.withColumn("objective", o)
    return obj


def expression_objective(expr: Column) -> Objective:
    """A closed-form objective (tests and what-if scoring)."""
    return lambda df: df.withColumn("objective", expr)


# ------------------------------------------------------------------ bounds
def solver_bounds(current: DataFrame, td: DataFrame, value_col: str = "value") -> DataFrame:
    """OPT7: per (run, control) ``lo = max(op_min, x − Δ)``, ``hi = min(op_max, x + Δ)``.

    ``greatest/least`` skip NULL, which is right here: a missing Δ or
    operating limit leaves that side to the other term.  ``bad_bounds`` flags
    ``lo > hi``."""
    t = td.select("tag", "op_min", "op_max", "max_delta")
    j = current.join(t, "tag", "left")
    x, d = F.col(value_col), F.col("max_delta")
    lo = F.greatest(F.col("op_min"), x - d)
    hi = F.least(F.col("op_max"), x + d)
    return j.select(*current.columns, lo.alias("lo"), hi.alias("hi"),
                    F.coalesce(lo > hi, F.lit(False)).alias("bad_bounds"))


def parse_constraint_set(c: str) -> Column:
    """``"[20, 40]"`` text → ``ARRAY<DOUBLE>``."""
    return F.from_json(F.col(c), "array<double>")


def set_repair(value: Column, allowed: Column) -> Column:
    """OPT8: nearest allowed value (ties → the smaller value)."""
    pairs = F.transform(allowed, lambda s: F.struct(F.abs(value - s).alias("d"), s.alias("s")))
    return F.when(F.size(allowed) > 0, F.array_min(pairs)["s"]).otherwise(value)


def free_controls(values_long: DataFrame, controls: DataFrame, closure: DataFrame,
                  run_col: str = "run_id") -> DataFrame:
    """OPT6: a control is free in a run when its value is not NULL and every
    on/off tag it depends on (transitively, QC2) is > 0.5 in that run.

    ``values_long`` = ``(run_id, tag, value)``."""
    ctl = controls.select("tag")
    deps = closure.join(ctl, "tag")  # (tag=control, dependency)
    dv = values_long.select(run_col, F.col("tag").alias("dependency"), F.col("value").alias("dep_value"))
    cv = values_long.join(ctl, "tag")
    j = cv.join(deps, "tag", "left").join(dv, [run_col, "dependency"], "left")
    on = F.coalesce(F.col("dep_value") > 0.5, F.lit(False)) | F.col("dependency").isNull()
    return j.groupBy(run_col, "tag").agg(
        (F.bool_and(on) & F.first(F.col("value").isNotNull())).alias("free"))


def control_range(td: DataFrame, n_points: int = 50) -> DataFrame:
    """OPT14: ``(tag, values ARRAY<DOUBLE>)`` — the constraint set (cast to int),
    else ``n`` steps over the operating range, else over the physical range;
    upper end excluded."""
    cs = F.transform(parse_constraint_set("constraint_set"), lambda v: v.cast("long").cast("double"))
    lo = F.coalesce(F.col("op_min"), F.col("range_min"))
    hi = F.coalesce(F.col("op_max"), F.col("range_max"))
    step = (hi - lo) / F.lit(float(n_points))
    grid = F.transform(F.sequence(F.lit(0), F.lit(n_points - 1)), lambda i: lo + i * step)
    return td.select("tag", F.when(F.col("constraint_set").isNotNull(), cs).otherwise(grid).alias("values"))


def linspace(lo: Column, hi: Column, n: int) -> Column:
    """OPT16 grid: ``n`` points with **both** ends."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda i: lo + i * (hi - lo) / F.lit(float(n - 1)))


# ------------------------------------------------------------------ sensitivity
def sensitivity(states: DataFrame, ranges: DataFrame, objective: Objective,
                run_col: str = "run_id") -> DataFrame:
    """OPT15/JOI8: objective along each control's range for every run.

    Each run row is exploded over the (small, per-control) value arrays —
    output grows as runs × Σ points, no join."""
    rng = {r["tag"]: r["values"] for r in ranges.collect()}  # one row per control
    parts = []
    for ctl, vals in rng.items():
        if not vals or any(v is None for v in vals):
            raise ValueError(f"control {ctl!r} has neither a constraint set nor a range")
        e = states.select("*", F.explode(F.array(*[F.lit(float(v)) for v in vals])).alias("_v"))
        e = e.withColumn(ctl, F.col("_v")).withColumn("control", F.lit(ctl)) \
             .withColumnRenamed("_v", "control_value")
        parts.append(objective(e).select(run_col, "ts", "control", "control_value",
                                         F.col("objective").alias("target_value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def control_limits(td: DataFrame) -> DataFrame:
    """OPT16: ``tag, lo, hi`` — the operating range, where one end is missing the physical range; tags without one, or with an empty one, go."""
    both = F.col("op_min").isNotNull() & F.col("op_max").isNotNull()
    lo, hi = (F.when(both, F.col(f"op_{e}")).otherwise(F.col(f"range_{e}")) for e in ("min", "max"))
    return td.select("tag", lo.alias("lo"), hi.alias("hi")).where("lo < hi")


def model_sensitivity(states: DataFrame, limits: DataFrame, predict: Objective, points: int = 50, ts_col: str = "ts") -> DataFrame:
    """OPT16: ``variable, value, ts, target`` — every row of ``states`` with each variable of ``limits`` at ``points`` values over its
    range, both ends included, scored by ``predict`` (adds ``objective``).

    One pass for all variables: a row is exploded over the variables' values and scored once."""
    rows = limits.collect()  # one row a variable
    if not rows:
        raise ValueError("no variable has a range")
    cells = F.flatten(F.array(*[_cells(r.tag, r.lo, r.hi, points) for r in rows]))
    e = states.withColumn("_c", F.explode(cells))
    e = e.withColumns({r.tag: F.when(F.col("_c.variable") == r.tag, F.col("_c.value")).otherwise(F.col(r.tag)) for r in rows})
    return predict(e).select(F.col("_c.variable").alias("variable"), F.col("_c.value").alias("value"), ts_col, F.col("objective").alias("target"))


def _cells(tag: str, lo: float, hi: float, points: int) -> Column:
    return F.transform(linspace(F.lit(float(lo)), F.lit(float(hi)), points), lambda v: F.struct(F.lit(tag).alias("variable"), v.alias("value")))


def sensitivity_pivot(curves: DataFrame, stamps: Sequence, ts_col: str = "ts") -> DataFrame:
    """OPT16: one row per variable and value, one column ``t1, t2, …`` per listed time."""
    cols = [F.max(F.when(F.col(ts_col) == F.lit(t).cast("timestamp_ntz"), F.col("target"))).alias(f"t{k + 1}") for k, t in enumerate(stamps)]
    return curves.groupBy("variable", "value").agg(*cols)


def what_if(states: DataFrame, overrides: Mapping[str, float], objective: Objective) -> DataFrame:
    """OPT17: override some state/control values and re-score."""
    d = states.select(*[c for c in states.columns if c not in overrides],
                      *[F.lit(float(v)).alias(k) for k, v in overrides.items()])
    return objective(d)


# ------------------------------------------------------------------ search
def _u(*parts: Column) -> Column:
    """Uniform [0, 1) from a seeded 64-bit hash (repeatable under retries)."""
    h = F.xxhash64(*parts)
    return (F.pmod(h, F.lit(1 << 30)).cast("double")) / F.lit(float(1 << 30))


def _control_space(runs: DataFrame, td: DataFrame, closure: DataFrame, controls: Sequence[str]) -> dict[str, dict[str, Column]]:
    """Per control the columns ``free, lo, hi, allowed`` of a run (OPT6–OPT8); the dictionary is metadata and read once."""
    limits = {r.tag: r for r in td.where(F.col("tag").isin(list(controls))).select(
        "tag", "op_min", "op_max", "max_delta", parse_constraint_set("constraint_set").alias("allowed")).collect()}
    deps = closure.where(F.col("tag").isin(list(controls))).collect()
    out = {}
    for c in controls:
        r = limits.get(c)
        if r is None or r.op_min is None or r.op_max is None:
            raise ValueError(f"control {c!r} needs an operating range")
        x = F.col(c)
        free = x.isNotNull()
        for d in sorted({q.dependency for q in deps if q.tag == c}):
            if d not in runs.columns:
                raise ValueError(f"control {c!r} depends on {d!r}, which the runs do not have")
            free = free & F.coalesce(F.col(d) > 0.5, F.lit(False))
        lo, hi = F.lit(float(r.op_min)), F.lit(float(r.op_max))
        inside = F.least(F.greatest(x, lo), hi)
        if r.max_delta is not None:  # a value too far outside its range can only go to the nearest end
            near_lo, near_hi = F.greatest(lo, x - r.max_delta), F.least(hi, x + r.max_delta)
            bad = near_lo > near_hi
            lo, hi = F.when(bad, inside).otherwise(near_lo), F.when(bad, inside).otherwise(near_hi)
        allowed = F.array(*[F.lit(float(v)) for v in r.allowed or []]).cast("array<double>")
        out[c] = {"free": free, "lo": lo, "hi": hi, "allowed": allowed}
    return out


def search_controls(runs: DataFrame, td: DataFrame, closure: DataFrame, controls: Sequence[str], objective: Objective,
                    run_col: str = "run_id", pop: int = 15, max_gen: int = 150, patience: int = 5, tol: float = 0.1,
                    mutation: float = 0.7, crossover: float = 0.7, seed: int = 0, sense: str = "maximize") -> DataFrame:
    """OPT9 + OPT10: the best controls of every run by differential evolution (rand/1/bin).

    Bounds are those of the run (OPT7), values go to the nearest one of a
    constraint set within them (OPT8), and a control that is missing or off stays
    as it is (OPT6).  A run's population is one array in one row; a generation
    makes its trials there, explodes them only to be scored, and gathers them
    again: one shuffle.  A run whose best gained less than ``tol`` for
    ``patience`` generations is frozen; the search ends when all are, or after
    ``max_gen``.  Every generation is written to the shared folder.

    Returns ``runs`` with ``free_<c>, lo_<c>, hi_<c>, new_<c>`` per control,
    ``objective_current`` and ``objective``; without a score all stays as it is.
    """
    sign = F.lit(1.0 if sense == "maximize" else -1.0)
    space = _control_space(runs, td, closure, controls)
    base = runs.withColumns({f"{k}_{c}": space[c][k] for c in controls for k in ("free", "lo", "hi")})
    base = written(objective(base).withColumnRenamed("objective", "objective_current"), "runs")
    run = F.col(run_col)

    def settle(c: str, v: Column) -> Column:
        v = F.least(F.greatest(v, F.col(f"lo_{c}")), F.col(f"hi_{c}"))
        within = F.filter(space[c]["allowed"], lambda s: (s >= F.col(f"lo_{c}")) & (s <= F.col(f"hi_{c}")))
        sets = F.when(F.size(within) > 0, within).otherwise(space[c]["allowed"])
        return F.when(F.col(f"free_{c}"), set_repair(v, sets)).otherwise(F.col(c)).cast("double")

    def scored(rows: DataFrame) -> DataFrame:
        """``run, trials`` with the fitness of each, from rows of ``base`` with an array ``trials`` of controls."""
        keep = [x for x in runs.columns if x not in controls and x != "trials"]
        one = rows.select(*keep, F.posexplode("trials").alias("_i", "_t"))
        one = objective(one.select(*keep, "_i", *[F.col(f"_t.{c}").alias(c) for c in controls]))
        cell = F.struct("_i", *controls, (sign * F.col("objective")).alias("fit"))
        return one.groupBy(run_col).agg(F.transform(F.array_sort(F.collect_list(cell)), lambda t: F.struct(
            *[t[c].alias(c) for c in controls], t["fit"].alias("fit"))).alias("scored"))

    seats = F.sequence(F.lit(0), F.lit(pop - 1))
    # seat 0 is the run as it is
    first = F.transform(seats, lambda k: F.struct(*[settle(c, F.when(k == 0, F.col(c)).otherwise(
        F.col(f"lo_{c}") + _u(run, F.lit(seed), k, F.lit(i)) * (F.col(f"hi_{c}") - F.col(f"lo_{c}")))).alias(c)
        for i, c in enumerate(controls)]))
    best = F.aggregate("pop", F.lit(None).cast("double"), lambda m, t: F.greatest(m, t["fit"]))
    now = scored(base.withColumn("trials", first)).withColumnRenamed("scored", "pop")
    now = written(now.select(run_col, "pop", best.alias("best"), F.lit(0).alias("stall")), "generation")
    for gen in range(1, max_gen + 1):
        active = now.where(F.col("stall") < patience)
        if active.isEmpty():
            break
        g = F.lit(gen)

        def trial(k: Column) -> Column:
            others = F.array_sort(F.transform(F.filter(seats, lambda j: j != k), lambda j: F.struct(
                F.xxhash64(run, F.lit(seed), g, k, j).alias("h"), j.alias("j"))))
            a, b, c3 = (F.element_at("pop", others[n]["j"] + 1) for n in range(3))
            own = F.element_at("pop", k + 1)
            sure = F.floor(_u(run, F.lit(seed), g, k, F.lit(-1)) * len(controls))
            return F.struct(*[settle(c, F.when(
                (sure == i) | (_u(run, F.lit(seed), g, k, F.lit(i)) < crossover),
                a[c] + mutation * (b[c] - c3[c])).otherwise(own[c])).alias(c) for i, c in enumerate(controls)])

        rows = base.join(active, run_col).withColumn("trials", F.transform(seats, trial))
        better = F.zip_with("pop", "scored", lambda old, new: F.when(
            F.coalesce(new["fit"] >= old["fit"], new["fit"].isNotNull()), new).otherwise(old))
        new = active.join(scored(rows), run_col).withColumn("pop", better)
        gained = F.coalesce(best - F.col("best") >= tol, best.isNotNull() & F.col("best").isNull())
        new = new.select(run_col, "pop", best.alias("best"), F.when(gained, 0).otherwise(F.col("stall") + 1).alias("stall"))
        now = written(new.unionByName(now.where(F.col("stall") >= patience)), "generation")
    top = F.array_max(F.transform(F.filter("pop", lambda t: t["fit"].isNotNull()), lambda t: F.struct(
        t["fit"].alias("fit"), *[t[c].alias(c) for c in controls])))
    won = now.select(run_col, top.alias("_w"))
    return base.join(won, run_col).select(*base.columns, *[F.when(F.col("_w").isNull(), F.col(c)).otherwise(F.col(f"_w.{c}")).alias(f"new_{c}") for c in controls],
                                          (sign * F.col("_w.fit")).alias("objective"))


# ------------------------------------------------------------------ result tables
def recommendation_records(found: DataFrame, controls: Sequence[str], states: Sequence[str], run_col: str = "run_id") -> DataFrame:
    """OPT11: nested record per run of :func:`search_controls` — ``state`` map, ``controls`` map of
    ``struct(current, suggested, delta)``, objective — ready for ``write.json`` (SNK2)."""
    # fixed values: names of the record's fields
    ctl = F.map_from_arrays(
        F.array(*[F.lit(c) for c in controls]),
        F.array(*[F.struct(F.col(c).alias("current"), F.col(f"new_{c}").alias("suggested"),
                           (F.col(f"new_{c}") - F.col(c)).alias("delta")) for c in controls]))
    st = F.map_from_arrays(F.array(*[F.lit(s) for s in states]),
                           F.array(*[F.col(s).cast("double") for s in states]))
    return found.select(run_col, "ts", st.alias("state"), ctl.alias("controls"),
                        F.col("objective_current"), F.col("objective").alias("objective_suggested"))


def controls_sheet(rows: DataFrame, stamps: Sequence, value: str = "suggested") -> DataFrame:
    """OPT13: one row per control, one column per listed run time."""
    cell = [F.max(F.when(F.col("ts") == F.lit(t).cast("timestamp_ntz"), F.col(value))).alias(str(t)) for t in stamps]
    return rows.groupBy("tag_id").agg(*cell)


def control_rows(records: DataFrame, run_col: str = "run_id") -> DataFrame:
    """OPT12: long control rows ``(run_id, ts, tag_id, current, suggested, delta)`` (D21)."""
    e = records.select(run_col, "ts", F.explode("controls").alias("tag_id", "c"))
    return e.select(run_col, "ts", "tag_id", "c.current", "c.suggested", "c.delta")


def uplift(records: DataFrame, actual: DataFrame | None = None, run_col: str = "run_id") -> DataFrame:
    """OPT12: uplift vs predicted (absolute and %), and vs actual when given (JOI12)."""
    d = records.select(run_col, "ts", "objective_current", "objective_suggested",
                       (F.col("objective_suggested") - F.col("objective_current")).alias("uplift_pred"))
    from sensorloom.functions.exprs import safe_div
    d = d.withColumn("uplift_pred_pct", F.lit(100.0) * safe_div("uplift_pred", "objective_current"))
    if actual is not None:
        d = d.join(actual, run_col, "left").withColumn(
            "uplift_actual", F.col("objective_suggested") - F.col("actual"))
        d = d.withColumn("uplift_actual_pct", F.lit(100.0) * safe_div("uplift_actual", "actual"))
    return d


def objective_sheet(up: DataFrame, models: Sequence[str] = ()) -> DataFrame:
    """OPT13: one row per run time: the models' predictions (columns ``pred_<model>`` where given), the target as it is and as
    suggested, and ``uplift_pred`` in percent of the target as it is (NULL where that is 0)."""
    return up.select("ts", *[f"pred_{m}" for m in models], F.col("objective_current").alias("target_pred_current"),
                     F.col("objective_suggested").alias("target_pred_optimized"), F.col("uplift_pred_pct").alias("uplift_pred"))


def context_rows(cols: Sequence[str], window: int, w: WindowSpec) -> Column:
    """OPT18: the ``window − 1`` rows before each row as ``ARRAY<STRUCT>``, oldest first; for use in a halo pass (``windows.positional``)."""
    return F.collect_list(F.struct(*cols)).over(w.rowsBetween(-(window - 1), -1))
