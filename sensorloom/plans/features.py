"""Registered queries: domain features (§2.10) and the as-of relining join."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.functions.exprs import cut, on_off, row_mean, safe_div
from sensorloom.operators import features as FE
from sensorloom.operators import joins as J
from sensorloom.operators.grid import grid_position
from sensorloom.plans.common import SQL_HOURLY, finish, register, sql_bin_left, sql_r
from sensorloom.sources import fixtures as FX

BUCKET = 256


# SQL mirrors of the Column helpers ------------------------------------------------
def s_div(n, d, fill=None):
    f = "NULL" if fill is None else repr(float(fill))
    return f"(CASE WHEN ({d}) = 0 THEN CASE WHEN ({n}) = 0 THEN NULL ELSE {f} END ELSE ({n}) / ({d}) END)"


def s_cut(x, lo, hi):
    return f"(CASE WHEN ({x}) >= {lo} AND ({x}) <= {hi} THEN ({x}) END)"


def s_rsum(xs):
    return "(" + " + ".join(f"coalesce(CAST({x} AS DOUBLE), 0.0)" for x in xs) + ")"


def s_rmean(xs):
    cnt = " + ".join(f"CAST(({x}) IS NOT NULL AS INTEGER)" for x in xs)
    return f"({s_rsum(xs)} / nullif({cnt}, 0))"


# lineitem-derived "cells"
def _cells():
    return {
        "c1": F.col("l_quantity"),
        "c2": F.col("l_discount") * 100.0,
        "c3": F.col("l_tax") * 100.0,
        "c4": F.col("l_extendedprice") / 1000.0,
    }
CELLS_SQL = {"c1": "l_quantity", "c2": "l_discount * 100.0", "c3": "l_tax * 100.0",
             "c4": "l_extendedprice / 1000.0"}


def _metallurgy(spark, sf_dir):
    """F9 grades plus four lineitem-derived "cells" and a second tails line."""
    src = FX.table(spark, sf_dir, "lineitem")
    return src.select("l_orderkey", "l_linenumber", "l_tax",
                      *[c.alias(n) for n, c in _cells().items()],
                      (F.lit(0.5) + F.lit(15.0) * F.col("l_tax")).alias("feed"),
                      (F.lit(20.0) + F.col("l_quantity") / F.lit(5.0)).alias("conc"),
                      (F.lit(0.02) + F.lit(3.0) * F.col("l_discount")).alias("tails"),
                      (F.lit(0.02) + F.lit(2.0) * F.col("l_tax")).alias("tails2"),
                      F.col("l_quantity").alias("tph"))


_MET_SQL = f"""m AS (SELECT l_orderkey, l_linenumber, l_tax,
  {", ".join(f"{v} AS {k}" for k, v in CELLS_SQL.items())},
  0.5 + 15.0 * l_tax AS feed, 20.0 + l_quantity / 5.0 AS conc,
  0.02 + 3.0 * l_discount AS tails, 0.02 + 2.0 * l_tax AS tails2, l_quantity AS tph
  FROM lineitem)"""


def _flot_sql() -> str:
    f = s_cut("feed", 0.5, 2.0)
    t1, t2 = s_cut("tails", 0.02, 0.4), s_cut("tails2", 0.02, 0.4)
    tw = f"(0.0 + {t1} * 0.5 + {t2} * 0.5)"
    rec = lambda t: s_cut(s_div(f"conc * ({f} - {t})", f"{f} * (conc - {t})"), 0, 1)
    peso = lambda t: s_cut(s_div(f"{f} - {t}", f"conc - {t}"), 0, 1)
    cols = {
        "d_c2_c1": "c2 - c1", "d_c3_c2": "c3 - c2", "d_c4_c3": "c4 - c3",
        "bank2_bank1": "(c3 + c4) / 2.0 - (c1 + c2) / 2.0",
        "mean_line": s_rmean([s_cut(c, 1, 50) for c in ["c1", "c2", "c3", "c4"]]),
        "delta_air": "c3 - c1",
        "fe_cu": s_cut(s_div(s_rmean(["c1", "c2"]), s_rmean(["c3", "c4"])), 0, 5),
        "flot_recup_peso_l1": peso(t1), "flot_recup_peso_l2": peso(t2),
        "flot_recup_l1": rec(t1), "flot_recup_l2": rec(t2),
        "flot_recup_wt": s_cut(s_div(f"conc * ({f} - {tw})", f"{f} * (conc - {tw})"), 0, 1),
        "dosing_c2": s_cut(s_div(f"c2 * {0.87 * 60.0!r}", f"{s_rsum(['tph'])} * 0.97"), 0, 5),
    }
    cols["cuf"] = f"{s_rsum(['tph'])} * ({cols['flot_recup_wt']}) * feed / 100.0"
    sel = ", ".join(f"{sql_r(v)} AS {k}" for k, v in cols.items())
    return f"WITH {_MET_SQL} SELECT l_orderkey, l_linenumber, {sel} FROM m"


@register("features_flotation", _flot_sql())
def features_flotation(spark, sf_dir):
    """FEA1 cell diffs, FEA2 bank diffs, FEA3 line mean, FEA4 air delta, FEA5 Fe/Cu,
    FEA6 mass pull + recoveries, FEA7 fine copper, FEA11 reagent dosing (one select)."""
    m = FE.with_flotation_targets(_metallurgy(spark, sf_dir), "conc", "feed", ["tails", "tails2"], [0.5, 0.5], "flot")
    m = m.withColumns({"_fe_cu": safe_div(row_mean(["c1", "c2"]), row_mean(["c3", "c4"])),
                       "_dosing": FE.reagent_ratio("c2", ["tph"], 0.87, 0.97)})
    cols = dict(FE.diff_cells(["c1", "c2", "c3", "c4"], "d"))
    cols.update({"bank2_bank1": FE.diff_banks(["c1", "c2", "c3", "c4"], "b")["b_bank2_bank1"]})
    cols["mean_line"] = FE.mean_by_line(["c1", "c2", "c3", "c4"], 1, 50)
    cols["delta_air"] = FE.delta_first_penultimate(["c1", "c2", "c3", "c4"])
    cols["fe_cu"] = cut("_fe_cu", 0, 5)
    cols.update({c: F.col(c) for c in m.columns if c.startswith("flot_")})
    cols["dosing_c2"] = cut("_dosing", 0, 5)
    cols["cuf"] = FE.fine_copper(["tph"], "flot_recup_wt", "feed")
    return finish(m.select("l_orderkey", "l_linenumber", *[v.alias(k) for k, v in cols.items()]))


def _grind_sql() -> str:
    parts = ["c1", "c2", "c3"]
    total = s_rsum(parts)
    ratio = s_div("c1", "c2")
    cols = {
        "solids_frac": s_div("c1", "c4 + c1", 0),
        "spec_power": s_div(s_rsum(["c1"]), "c3 * 1000.0", 0),
        "tph_total": s_rsum(["c1", "c2"]),
        "tph_ratio": ratio,
        "pebbles": f"(CASE WHEN {s_div('c2', 'c1', 0)} > 1 THEN 0.0 ELSE {s_div('c2', 'c1', 0)} END)",
        **{f"{p}_share": s_div(p, total) for p in parts},
        "water_bal": f"(({s_rsum(['c1', 'c2'])} - c3 + (CASE WHEN l_tax > 0 THEN c4 ELSE 0.0 END)) * 3.6)",
        "water_t": s_div(s_rsum(["c2", "c3"]), s_rsum(["c1"])),
    }
    sel = ", ".join(f"{sql_r(v)} AS {k}" for k, v in cols.items())
    bins = "CASE WHEN c1 >= 0 AND c1 < 10 THEN 'low' WHEN c1 >= 10 AND c1 < 25 THEN 'mid' " \
           "WHEN c1 >= 25 AND c1 < 51 THEN 'high' END"
    return f"WITH {_MET_SQL} SELECT l_orderkey, l_linenumber, {sel}, {bins} AS size_bin FROM m"


@register("features_grinding", _grind_sql())
def features_grinding(spark, sf_dir):
    """FEA8 solids fraction, FEA10 specific power, FEA12/13 tph totals/ratio,
    FEA14 pebbles, FEA15/FEA25 shares, FEA19 water balance, FEA20 water per
    tonne, FEA24 binning."""
    m = _metallurgy(spark, sf_dir)
    sag = FE.sag_tph_targets("c1", "c2")
    cols = {"solids_frac": FE.solids_fraction("c1", "c4"),
            "spec_power": FE.specific_power(["c1"], "c3", 1000.0),
            "tph_total": sag["tph_total"], "tph_ratio": sag["tph_ratio"],
            "pebbles": FE.pebbles_share("c2", "c1"),
            **FE.feeder_share(["c1", "c2", "c3"]),
            "water_bal": FE.water_balance(["c1", "c2"], "c3", {"c4": "l_tax"}),
            "water_t": FE.water_per_tonne(["c2", "c3"], ["c1"]),
            "size_bin": FE.binned("c1", [0, 10, 25, 51], ["low", "mid", "high"])}
    return finish(m.select("l_orderkey", "l_linenumber", *[v.alias(k) for k, v in cols.items()]))


@register("features_hourly_objective", f"""
WITH h AS ({SQL_HOURLY})
SELECT ts,
  {sql_r(s_rmean(['click', 'error']) + ' - ' + s_rmean([s_rmean(['view', 'signup']), s_rmean(['purchase'])]))} AS objective,
  CASE WHEN click IS NULL OR click < 20 THEN 0 ELSE 1 END AS pump_on,
  CASE WHEN view IS NULL OR view > 90 THEN 0 ELSE 1 END AS line_on
FROM h
""")
def features_hourly_objective(spark, sf_dir):
    """FEA21 objective (mean torque − mean of unit mean densities), FEA9/FEA22
    on/off flags attached to the hourly table."""
    h = FX.hourly_wide(spark, sf_dir)
    return finish(h.select(
        "ts", FE.objective_column(["click", "error"], [["view", "signup"], ["purchase"]]).alias("objective"),
        on_off("click", "less_than", 20).alias("pump_on"),
        on_off("view", "greater_than", 90).alias("line_on")))


# ------------------------------------------------------------------ thickeners
SIGNALS = ["click", "view"]
DELTAS = [1, 6, 12]
ROLLS = [6, 12]
DEAD = 5
HL = 6.0
_D = 0.5 ** (1.0 / HL)


def _asset_hourly(spark, sf_dir):
    """Per-asset hourly panel on the complete hour grid: ``(asset, pos, ts, click, view)``."""
    ev = FX.long_sensors(spark, sf_dir).select("asset", F.col("tag"), "value",
                                               F.col("ts"))
    from sensorloom.functions.exprs import bin_left
    from sensorloom.operators.reshape import pivot_tags
    hourly = pivot_tags(ev.withColumn("ts", bin_left("ts", 3600)), ["asset", "ts"], SIGNALS)
    b = ev.agg(F.min(bin_left("ts", 3600)).alias("lo"), F.max(bin_left("ts", 3600)).alias("hi")).first()
    from sensorloom.functions.exprs import epoch_us
    lo_us = spark.range(1).select(epoch_us(F.lit(b["lo"]).cast("timestamp_ntz")).alias("x")).first()["x"]
    n = int((b["hi"] - b["lo"]).total_seconds() // 3600) + 1
    panel = ev.select("asset").distinct().select(
        "asset", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("pos"))
    hourly = hourly.withColumn("pos", grid_position("ts", lo_us, 3600)).drop("ts")
    from sensorloom.functions.exprs import from_epoch_us
    out = panel.join(hourly, ["asset", "pos"], "left")
    return out.withColumn("ts", from_epoch_us(F.lit(lo_us) + F.col("pos") * F.lit(3_600_000_000)))


def _thick_sql() -> str:
    w = "(PARTITION BY asset ORDER BY pos)"
    cols = []
    for s in SIGNALS:
        for k in DELTAS:
            cols.append(f"{sql_r(f'{s} - lag({s}, {k}) OVER {w}')} AS {s}_delta_{k}")
        for n in ROLLS:
            fr = f"(PARTITION BY asset ORDER BY pos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
            cols.append(f"{sql_r(f'CASE WHEN count({s}) OVER {fr} = {n} THEN avg({s}) OVER {fr} END')} AS {s}_roll_{n}")
    inner = []
    for s in SIGNALS:
        for n in ROLLS:
            fr = f"(PARTITION BY asset ORDER BY pos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
            inner.append(f"CASE WHEN count({s}) OVER {fr} = {n} THEN avg({s}) OVER {fr} END AS {s}_r{n}")
        inner.append(f"lag({s}, 1) OVER {w} AS {s}_l1")
    outer = []
    n = max(ROLLS)
    for s in SIGNALS:
        outer.append(f"{sql_r(f'lag({s}_r{n}, {DEAD}) OVER {w}')} AS {s}_roll_{n}_dead_{DEAD}")
        num = f"sum(CASE WHEN {s}_l1 IS NOT NULL THEN {s}_l1 * pow({_D!r}, -pos) END) OVER {w}"
        den = f"sum(CASE WHEN {s}_l1 IS NOT NULL THEN pow({_D!r}, -pos) END) OVER {w}"
        outer.append(f"{sql_r(f'({num}) / nullif({den}, 0)')} AS {s}_ewm")
    return f"""
WITH ev AS (SELECT (user_id % 8)::INTEGER AS asset, {sql_bin_left("ts", 3600)} AS ts, event_type, value FROM events),
h AS (SELECT asset, ts, {", ".join(f"avg(value) FILTER (WHERE event_type = '{s}') AS {s}" for s in SIGNALS)}
      FROM ev GROUP BY 1, 2),
b AS (SELECT min(ts) AS lo, max(ts) AS hi FROM ev),
panel AS (SELECT a.asset, p.pos, (SELECT lo FROM b) + to_hours(CAST(p.pos AS BIGINT)) AS ts
          FROM (SELECT DISTINCT asset FROM ev) a,
               (SELECT range AS pos FROM range(0, (SELECT CAST(epoch(hi - lo) / 3600 AS BIGINT) + 1 FROM b))) p),
g AS (SELECT panel.asset, panel.pos, panel.ts, {", ".join("h." + s for s in SIGNALS)}
      FROM panel LEFT JOIN h ON h.asset = panel.asset AND h.ts = panel.ts),
x AS (SELECT *, {", ".join(inner)} FROM g)
SELECT asset, ts, {", ".join(cols)}, {", ".join(outer)} FROM x
"""


@register("features_thickener", _thick_sql())
def features_thickener(spark, sf_dir):
    """FEA18 (WIN2/WIN3/WIN5/WIN6/WIN7): one parametrised feature job for all
    eight units (asset = user_id % 8) on their hourly grids."""
    panel = _asset_hourly(spark, sf_dir)
    d = FE.thickener_features(panel, ["asset"], "pos", SIGNALS, DELTAS, ROLLS, HL, DEAD, BUCKET)
    keep = ["asset", "ts"]
    for s in SIGNALS:
        keep += [f"{s}_delta_{k}" for k in DELTAS] + [f"{s}_roll_{n}" for n in ROLLS]
    keep += [c for s in SIGNALS for c in (f"{s}_roll_{max(ROLLS)}_dead_{DEAD}", f"{s}_ewm")]
    return finish(d.select(*keep))


# ------------------------------------------------------------------ thickeners in full, 10-minute rows
ROLES = {"torque": ["click", "view"], "flocculant": ["error"], "density": ["purchase", "signup"],
         "valves": ["click", "error", "purchase", "signup"], "long": ["view", "signup"], "short": ["error", "purchase"], "cone": ["click"]}
# unit 5 has no turbidity (error_2h), unit 0 no interface level (view_6h); only unit 7 has a cone
ABSENT = {0: ["view_6h"], 5: ["error_2h"], **{u: ["cone_smooth", "delta_cone"] for u in (1, 2, 3, 4, 6)}}
ALL_TAGS = ["click", "error", "purchase", "signup", "view"]


def _asset_ten_minutes(spark, sf_dir):
    """Per-asset 10-minute panel on the complete grid, gaps filled forward (CLN9): ``(asset, pos, tags…)``."""
    from sensorloom.functions.exprs import bin_left, epoch_us
    from sensorloom.operators import windows as W
    from sensorloom.operators.reshape import pivot_tags
    ev = FX.long_sensors(spark, sf_dir).select("asset", "tag", "value", bin_left("ts", 600).alias("ts"))
    wide = pivot_tags(ev, ["asset", "ts"], ALL_TAGS)
    b = ev.agg(F.min(epoch_us("ts")).alias("lo"), F.max(epoch_us("ts")).alias("hi")).first()
    wide = wide.withColumn("pos", grid_position("ts", b["lo"], 600)).drop("ts")
    panel = ev.select("asset").distinct().select("asset", F.explode(F.sequence(
        F.lit(0).cast("long"), F.lit((b["hi"] - b["lo"]) // 600_000_000).cast("long"))).alias("pos"))
    return W.ffill(panel.join(wide, ["asset", "pos"], "left"), ["asset"], "pos", ALL_TAGS, BUCKET)


def _panel_sql() -> str:
    fill = ", ".join(f"last_value({t} IGNORE NULLS) OVER (PARTITION BY asset ORDER BY pos ROWS UNBOUNDED PRECEDING) AS {t}" for t in ALL_TAGS)
    return f"""ev AS (SELECT (user_id % 8)::INTEGER AS asset, {sql_bin_left("ts", 600)} AS ts, event_type, value FROM events),
lo AS (SELECT min(ts) AS lo, max(ts) AS hi FROM ev),
h AS (SELECT asset, CAST((epoch_us(ts) - (SELECT epoch_us(lo) FROM lo)) / 600000000 AS BIGINT) AS pos,
      {", ".join(f"avg(value) FILTER (WHERE event_type = '{t}') AS {t}" for t in ALL_TAGS)} FROM ev GROUP BY 1, 2),
panel AS (SELECT a.asset, p.pos FROM (SELECT DISTINCT asset FROM ev) a,
          (SELECT range AS pos FROM range(0, (SELECT CAST((epoch_us(hi) - epoch_us(lo)) / 600000000 AS BIGINT) + 1 FROM lo))) p),
g AS (SELECT asset, pos, {fill} FROM panel LEFT JOIN h USING (asset, pos))"""


def _w_roll(c: str, n: int, dead: int = 0) -> str:
    fr = f"(PARTITION BY asset ORDER BY pos ROWS BETWEEN {n - 1 + dead} PRECEDING AND {dead} PRECEDING)".replace("AND 0 PRECEDING", "AND CURRENT ROW")
    return f"CASE WHEN count({c}) OVER {fr} = {n} THEN avg({c}) OVER {fr} END"


def _w_ewm(c: str, half: float) -> str:
    d = 0.5 ** (1.0 / half)
    w = "(PARTITION BY asset ORDER BY pos)"
    return (f"sum(CASE WHEN {c} IS NOT NULL THEN {c} * pow({d!r}, -pos) END) OVER {w} / "
            f"nullif(sum(CASE WHEN {c} IS NOT NULL THEN pow({d!r}, -pos) END) OVER {w}, 0)")


def _units_sql() -> str:
    w = "(PARTITION BY asset ORDER BY pos)"
    outs = {f"delta_torque_{n}": f"target_torque - lag(target_torque, {k}) OVER {w}" for n, k in (("1", 1), ("1h", 6), ("2h", 12), ("4h", 24), ("8h", 48))}
    outs |= {"dosing": f"lag(e1, 48) OVER {w}", "density_smooth": f"lag(e2, 18) OVER {w}"}
    outs |= {f"{c}_6h": _w_roll(c, 36) for c in ROLES["long"]} | {f"{c}_2h": _w_roll(c, 12) for c in ROLES["short"]}
    outs |= {"cone_smooth": _w_roll("click", 6), "delta_cone": f"lag(click, 1) OVER {w} - lag(click, 2) OVER {w}"}
    for unit, names in ABSENT.items():
        outs |= {n: f"CASE WHEN asset <> {unit} THEN {outs[n]} END" for n in names}
    base = ["target_torque", "density_mean", "valves_mean", "valves_l1", "valves_l2"]
    cols = ", ".join([f"{sql_r(c)} AS {c}" for c in base] + [f"{sql_r(v)} AS {n}" for n, v in outs.items()])
    return f"""WITH {_panel_sql()},
t AS (SELECT *, {s_rmean(ROLES['torque'])} AS target_torque, {s_rmean(ROLES['density'])} AS density_mean, {s_rmean(ROLES['valves'])} AS valves_mean,
      {s_rmean(['click', 'signup'])} AS valves_l1, {s_rmean(['error', 'purchase'])} AS valves_l2 FROM g),
e AS (SELECT *, {_w_ewm('error', 12.0)} AS e1, {_w_ewm('density_mean', 6.0)} AS e2 FROM t)
SELECT asset, pos, {cols} FROM e"""


@register("thickener_units", _units_sql())
def thickener_units(spark, sf_dir):
    """FEA18 in full: target, five deltas, dosing and density chains, valves, rolling means and the
    rules of single units, for eight units on 10-minute rows."""
    d = FE.thickener_unit_features(_asset_ten_minutes(spark, sf_dir), ["asset"], "pos", ROLES, 6, "asset", ABSENT, BUCKET)
    return finish(d.drop(*ALL_TAGS))


def _chains_sql() -> str:
    w = "(PARTITION BY asset ORDER BY pos)"
    return f"""WITH {_panel_sql()},
a AS (SELECT *, ({s_rsum(['click', 'error'])} - coalesce(signup, 0.0)) * 3.6 AS fresh, click + view AS sag, {s_rsum(['purchase', 'error'])} AS conv,
      {s_rsum(['signup', 'view'])} AS water, {s_rmean([s_cut('purchase', 0, 95), s_cut('signup', 0, 95)])} AS solid FROM g),
b AS (SELECT *, sag + conv AS alls, {_w_ewm('error', 6.0)} AS e FROM a),
c AS (SELECT *, {_w_roll('alls', 12, 48)} AS tt FROM b),
d AS (SELECT *, {s_div('water', 'tt')} AS cea FROM c)
SELECT asset, pos, {sql_r(f'lag(fresh, 30) OVER {w}')} AS fresh_water, {sql_r(f'lag(sag, 48) OVER {w}')} AS throughput_sag,
  {sql_r(f'lag(conv, 48) OVER {w}')} AS throughput_conventional, {sql_r('tt')} AS throughput_total, {sql_r(_w_roll('solid', 12, 48))} AS solids,
  {sql_r(f'lag(e, 1) OVER {w}')} AS ph_smooth, {sql_r(_w_roll('click', 12, 48))} AS click_smooth, {sql_r(_w_roll('view', 12, 48))} AS view_smooth,
  {sql_r(_w_roll('cea', 12))} AS water_per_tonne FROM d"""


@register("thickener_plant_chains", _chains_sql())
def thickener_plant_chains(spark, sf_dir):
    """FEA19, FEA20: fresh water, throughput, solids, water per tonne and pH with their dead times."""
    d = FE.plant_chains(_asset_ten_minutes(spark, sf_dir), ["asset"], "pos", ["click", "error"], "signup", ["click", "view"],
                        ["purchase", "error"], ["purchase", "signup"], ["signup", "view"], "error", 6, BUCKET)
    return finish(d.drop(*ALL_TAGS))


@register("relining_days", f"""
WITH c AS (SELECT min(o_orderdate) AS start_ts FROM orders
           GROUP BY year(o_orderdate) * 2 + CASE WHEN month(o_orderdate) > 6 THEN 1 ELSE 0 END)
SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate,
       CAST(floor((epoch_us(l.l_shipdate) - epoch_us(c.start_ts)) / 86400000000) AS BIGINT) AS days_since_relining
FROM lineitem l ASOF LEFT JOIN c ON l.l_shipdate >= c.start_ts
""")
def relining_days(spark, sf_dir):
    """JOI7 as-of backward join: whole days since the latest campaign start ≤ ship date
    (NULL before the first), via validity intervals and a bucketed range join."""
    li = FX.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    out = J.days_since_last(li, FX.campaigns(spark, sf_dir), "l_shipdate", "start_ts",
                            "days_since_relining")
    return finish(out)

