"""Domain feature operators (FEA1–FEA26), spec-driven.

Row-wise features are Column expressions put into **one** ``select`` per
feature family (never hundreds of ``withColumn``).  Time features (deltas,
rolling means, EWM, lags) run over the long layout partitioned by asset
through :mod:`sensorloom.operators.windows`, so eight thickeners are eight
keys of one job rather than eight copies of the code.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.exprs import (
    col, cut, plain_mean, row_mean, row_sum, safe_div,
)
from sensorloom.operators import windows as W


# ------------------------------------------------------------------ flotation
def diff_cells(cells: Sequence[str], prefix: str) -> dict[str, Column]:
    """FEA1: consecutive cell differences ``c[i+1] − c[i]``."""
    return {f"{prefix}_{cells[i + 1]}_{cells[i]}": col(cells[i + 1]) - col(cells[i])
            for i in range(len(cells) - 1)}


def diff_banks(cells: Sequence[str], prefix: str) -> dict[str, Column]:
    """FEA2: bank = plain mean of two adjacent cells (NULL propagates), then bank differences."""
    banks = [plain_mean([cells[i], cells[i + 1]]) for i in range(0, len(cells) - 1, 2)]
    return {f"{prefix}_bank{i + 2}_bank{i + 1}": banks[i + 1] - banks[i]
            for i in range(len(banks) - 1)}


def mean_by_line(cells: Sequence[str], lo: float = 1, hi: float = 50) -> Column:
    """FEA3: values cut to ``[lo, hi]``, then the NULL-skipping row mean."""
    return row_mean([cut(c, lo, hi) for c in cells])


def delta_first_penultimate(cells: Sequence[str]) -> Column:
    """FEA4: penultimate cell minus the first."""
    return col(cells[-2]) - col(cells[0])


def fe_over_cu(fe: Sequence[str], cu: Sequence[str], lo: float = 0, hi: float = 5) -> Column:
    """FEA5: row mean Fe / row mean Cu, cut to ``[lo, hi]`` (÷0 → NULL)."""
    return cut(safe_div(row_mean(fe), row_mean(cu)), lo, hi)


def flotation_targets(conc: str, feed: str, tails: Sequence[str], weights: Sequence[float],
                      prefix: str, feed_range=(0.5, 2.0), tail_range=(0.02, 0.4)) -> dict[str, Column]:
    """FEA6 (after the CLN8 fill): mass pull and recovery per line and the
    weighted-tail recovery, every result cut to ``[0, 1]``.

    mass pull ``(f − t)/(c − t)``, recovery ``c(f − t) / (f(c − t))``.
    """
    f = cut(feed, *feed_range)
    c = col(conc)
    ts = [cut(t, *tail_range) for t in tails]
    out = {}
    for i, t in enumerate(ts):
        out[f"{prefix}_recup_peso_l{i + 1}"] = cut(safe_div(f - t, c - t), 0, 1)
    for i, t in enumerate(ts):
        out[f"{prefix}_recup_l{i + 1}"] = cut(safe_div(c * (f - t), f * (c - t)), 0, 1)
    tw = sum((t * F.lit(float(w)) for t, w in zip(ts, weights)), F.lit(0.0))
    out[f"{prefix}_recup_wt"] = cut(safe_div(c * (f - tw), f * (c - tw)), 0, 1)
    return out


def with_flotation_targets(df: DataFrame, conc: str, feed: str, tails: Sequence[str], weights: Sequence[float],
                           prefix: str, feed_range=(0.5, 2.0), tail_range=(0.02, 0.4)) -> DataFrame:
    """FEA6 as columns added to ``df``: the same values as :func:`flotation_targets`, in steps.

    Each step reads columns of the one before, so that no input expression is
    written out several times inside another and the generated code stays small."""
    c = col(conc)
    names = [f"_t{i}" for i in range(len(tails))]
    d = df.withColumns({"_f": cut(feed, *feed_range), **{n: cut(t, *tail_range) for n, t in zip(names, tails)}})
    d = d.withColumn("_tw", sum((F.col(n) * F.lit(float(w)) for n, w in zip(names, weights)), F.lit(0.0)))
    f = F.col("_f")
    raw = {f"{prefix}_recup_peso_l{i + 1}": safe_div(f - F.col(n), c - F.col(n)) for i, n in enumerate(names)}
    raw |= {f"{prefix}_recup_l{i + 1}": safe_div(c * (f - F.col(n)), f * (c - F.col(n))) for i, n in enumerate(names)}
    raw[f"{prefix}_recup_wt"] = safe_div(c * (f - F.col("_tw")), f * (c - F.col("_tw")))
    d = d.withColumns(raw)
    return d.withColumns({n: cut(n, 0, 1) for n in raw}).drop("_f", "_tw", *names)


def fine_copper(tph: Sequence[str], recovery: Column | str, feed: str) -> Column:
    """FEA7: ``Σ tph · recovery · feed / 100`` (±inf → NULL)."""
    return row_sum(tph) * col(recovery) * col(feed) / F.lit(100.0)


def solids_fraction(solids: str, water: str) -> Column:
    """FEA8: ``solids / (water + solids)``; ÷0 → 0 (0/0 stays NULL)."""
    return safe_div(col(solids), col(water) + col(solids), fill=0)


def specific_power(tonnes: Sequence[str], power: str, factor: float) -> Column:
    """FEA10: ``Σ tonnes / (power · factor)``; ÷0 → 0."""
    return safe_div(row_sum(tonnes), col(power) * F.lit(float(factor)), fill=0)


def reagent_dosing(reagent: str, tph: Sequence[str], density: float, dry_load: float,
                   lo: float, hi: float) -> Column:
    """FEA11: cc/min → g/t ``x · density · 60 / (Σ tph · dry)``, cut to ``[lo, hi]``."""
    return cut(reagent_ratio(reagent, tph, density, dry_load), lo, hi)


def reagent_ratio(reagent: str, tph: Sequence[str], density: float, dry_load: float) -> Column:
    """FEA11 before the cut."""
    return safe_div(col(reagent) * F.lit(density * 60.0), row_sum(tph) * F.lit(dry_load))


def total_tph(tph: Sequence[str]) -> Column:
    """FEA12: ``Σ tph`` (all-NULL → 0)."""
    return row_sum(tph)


def sag_tph_targets(mill_a: str, mill_b: str, compatible: bool = False) -> dict[str, Column]:
    """FEA13: per-mill tph, their ratio and the total.  The reference's total
    also adds the ratio (D8); ``compatible=True`` reproduces that."""
    ratio = safe_div(col(mill_a), col(mill_b))
    total = row_sum([mill_a, mill_b])
    if compatible:
        total = total + F.coalesce(ratio, F.lit(0.0))
    return {"tph_a": col(mill_a), "tph_b": col(mill_b), "tph_ratio": ratio, "tph_total": total}


def pebbles_share(pebbles: str, feed: str) -> Column:
    """FEA14: ``pebbles / feed``; ÷0 → 0; above 1 → 0."""
    p = safe_div(col(pebbles), col(feed), fill=0)
    return F.when(p > 1, F.lit(0.0)).otherwise(p)


def feeder_share(feeders: Sequence[str]) -> dict[str, Column]:
    """FEA15: each feeder's share of the group sum."""
    total = row_sum(feeders)
    return {f"{f}_share": safe_div(col(f), total) for f in feeders}


def binned(c: str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """FEA24: labelled ranges ``[e_i, e_{i+1})`` as a ``when`` chain (NULL outside)."""
    expr = None
    for i, lab in enumerate(labels):
        cond = (col(c) >= edges[i]) & (col(c) < edges[i + 1])
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def proportions(parts: Sequence[str]) -> dict[str, Column]:
    """FEA25: source-mix proportions of a blend."""
    total = row_sum(parts)
    return {f"{p}_prop": safe_div(col(p), total) for p in parts}


def water_balance(inflows: Sequence[str], outflow: str, gated: Mapping[str, str] | None = None,
                  factor: float = 3.6) -> Column:
    """FEA19: ``(Σ inflows − outflow + Σ gated terms) · 3.6`` (l/s → m³/h).

    A gated term counts only while its gate tag is > 0 (the reference's
    selector is constant 0, D11, so its term is 0 there)."""
    gated = gated or {}
    g = sum((F.when(col(gate) > 0, col(term)).otherwise(F.lit(0.0)) for term, gate in gated.items()),
            F.lit(0.0))
    return (row_sum(inflows) - col(outflow) + g) * F.lit(factor)


def water_per_tonne(water: Sequence[str], tonnes: Sequence[str]) -> Column:
    """FEA20: water intensity ``Σ water / Σ tonnes`` (÷0 → NULL)."""
    return safe_div(row_sum(water), row_sum(tonnes))


# ------------------------------------------------------------------ thickeners
def thickener_features(long: DataFrame, keys: Sequence[str], pos_col: str, signals: Sequence[str],
                       deltas: Sequence[int] = (1, 6, 12, 24, 48), roll: Sequence[int] = (6, 12),
                       ewm_halflife: float = 6.0, dead_time: int = 5,
                       bucket_rows: int = W.DEFAULT_BUCKET_ROWS) -> DataFrame:
    """FEA18 (+WIN2/3/5/6/7): one parametrised operator for every unit.

    Input is wide per unit: ``(keys…, pos, signal columns…)`` on a complete
    grid.  Adds for every signal: deltas to ``k`` rows ago, full-window rolling
    means, an EWM of the previous row, and the rolling mean shifted by the
    dead time.  Two passes for any number of signals: one carry scan for the
    EWMs (an EWM of a lag is the lag of the EWM), then one halo pass.
    """
    n = max(roll)
    back = max([*deltas, n - 1 + dead_time, 1])
    d = W.ewm_means(long, keys, pos_col, [(s, ewm_halflife, f"_e_{s}") for s in signals], bucket_rows)

    def build(w):
        out = {}
        for s in signals:
            for k in deltas:
                out[f"{s}_delta_{k}"] = W.diff_expr(s, k, w)
            for m in roll:
                out[f"{s}_roll_{m}"] = W.rolling_full_mean(s, m, w)
            out[f"{s}_lag1"] = F.lag(s, 1).over(w)
            out[f"{s}_roll_{n}_dead_{dead_time}"] = W.rolling_full_mean(s, n, w, dead_time)
            out[f"{s}_ewm"] = F.lag(f"_e_{s}", 1).over(w)
        return out
    d = W.positional(d, keys, pos_col, build, back=back, bucket_rows=max(bucket_rows, back))
    return d.drop(*[f"_e_{s}" for s in signals])


def thickener_unit_features(df: DataFrame, keys: Sequence[str], pos_col: str, roles: Mapping[str, Sequence[str]], hour: int = 6,
                            unit_col: str = "unit", absent: Mapping[str, Sequence[str]] | None = None,
                            bucket_rows: int = W.DEFAULT_BUCKET_ROWS) -> DataFrame:
    """FEA18 in full, on rows of ``60 / hour`` minutes, for all units at once.

    ``roles`` names the columns: ``torque`` (mean is the target), ``flocculant``,
    ``density`` (pair), ``valves`` (four; lines are first and last, and the
    middle two), ``long`` (six-hour means), ``short`` (two-hour means), ``cone``.
    ``absent`` lists outputs that a unit does not have; they are NULL there.
    """
    floc, = roles["flocculant"]
    cone, = roles["cone"]
    v = list(roles["valves"])
    d = df.withColumns({"target_torque": row_mean(roles["torque"]), "density_mean": row_mean(roles["density"]),
                        "valves_mean": row_mean(v), "valves_l1": row_mean([v[0], v[3]]), "valves_l2": row_mean([v[1], v[2]])})
    d = W.ewm_means(d, keys, pos_col, [(floc, 2.0 * hour, "_floc"), ("density_mean", 1.0 * hour, "_dens")], bucket_rows)
    steps = {"1": 1, "1h": hour, "2h": 2 * hour, "4h": 4 * hour, "8h": 8 * hour}

    def build(w):
        out = {f"delta_torque_{n}": W.diff_expr("target_torque", k, w) for n, k in steps.items()}
        out["dosing"] = F.lag("_floc", 8 * hour).over(w)
        out["density_smooth"] = F.lag("_dens", 3 * hour).over(w)
        out |= {f"{c}_6h": W.rolling_full_mean(c, 6 * hour, w) for c in roles["long"]}
        out |= {f"{c}_2h": W.rolling_full_mean(c, 2 * hour, w) for c in roles["short"]}
        out["cone_smooth"] = W.rolling_full_mean(cone, 6, w)
        out["delta_cone"] = F.lag(cone, 1).over(w) - F.lag(cone, 2).over(w)
        return out
    reach = max(8 * hour, 6 * hour)
    d = W.positional(d, keys, pos_col, build, back=reach, bucket_rows=max(bucket_rows, reach)).drop("_floc", "_dens")
    for unit, names in (absent or {}).items():
        d = d.withColumns({n: F.when(F.col(unit_col) != unit, F.col(n)) for n in names})
    return d


def plant_chains(df: DataFrame, keys: Sequence[str], pos_col: str, inflows: Sequence[str], outflow: str, sag: Sequence[str],
                 conventional: Sequence[str], solids: Sequence[str], water: Sequence[str], ph: str, hour: int = 6,
                 bucket_rows: int = W.DEFAULT_BUCKET_ROWS) -> DataFrame:
    """FEA19 and FEA20: fresh water with its five hours of dead time, throughput and solids chains with eight,
    water per tonne and smoothed pH.

    Row sums skip NULLs, except that the two SAG lines must both be there."""
    dead, two = 8 * hour, 2 * hour
    clean = {f"_s_{c}": cut(c, 0, 95) for c in solids}
    d = df.withColumns({"_fresh": (row_sum(inflows) - F.coalesce(F.col(outflow), F.lit(0.0))) * 3.6,
                        "_sag": sum((F.col(c) for c in sag[1:]), F.col(sag[0])), "_conv": row_sum(conventional), "_water": row_sum(water), **clean})
    d = d.withColumns({"_all": F.col("_sag") + F.col("_conv"), "_solid": row_mean(list(clean))})
    d = W.ewm_means(d, keys, pos_col, [(ph, 1.0 * hour, "_ph")], bucket_rows)

    def build(w):
        return {"fresh_water": F.lag("_fresh", 5 * hour).over(w), "throughput_sag": F.lag("_sag", dead).over(w),
                "throughput_conventional": F.lag("_conv", dead).over(w), "throughput_total": W.rolling_full_mean("_all", two, w, dead),
                "solids": W.rolling_full_mean("_solid", two, w, dead), "ph_smooth": F.lag("_ph", 1).over(w),
                **{f"{c}_smooth": W.rolling_full_mean(c, two, w, dead) for c in sag}}
    reach = dead + two
    B = max(bucket_rows, reach)
    d = W.positional(d, keys, pos_col, build, back=reach, bucket_rows=B)
    d = d.withColumn("_cea", safe_div("_water", "throughput_total"))
    d = W.positional(d, keys, pos_col, lambda w: {"water_per_tonne": W.rolling_full_mean("_cea", two, w)}, back=two, bucket_rows=B)
    return d.drop("_fresh", "_sag", "_conv", "_water", "_all", "_solid", "_ph", "_cea", *clean)


def objective_column(torque: Sequence[str], density: Sequence[Sequence[str]]) -> Column:
    """FEA21: mean torque − mean over units of each unit's mean density."""
    unit_means = [row_mean(d) for d in density]
    return row_mean(torque) - row_mean(unit_means)
