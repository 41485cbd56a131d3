"""Registered queries: feature bundles from specs (FEA17) and the plant KPIs (FEA23)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.operators import specs as S
from sensorloom.plans.common import finish, register, sql_bin_left, sql_r
from sensorloom.plans.features import _asset_hourly, s_cut, s_div, s_rmean, s_rsum
from sensorloom.sources import fixtures as FX

BUCKET = 256
HOURLY = ["click", "view"]

# grades and flows of one line, from the hourly panel; an hour of an asset without events stays NULL
BASE = {"conc": "20.0 + view / 5.0", "feed": "0.5 + click / 90.0", "t1": "0.02 + click / 300.0", "t2": "0.02 + view / 250.0",
        "tph1": "click * 20.0", "tph2": "view * 15.0", "c1": "click / 2.0", "c2": "view / 3.0", "c3": "click / 4.0", "c4": "view", "reagent": "click + 7.0"}
PARAMS = {"flotation": {"conc": "conc", "feed": "feed", "tails": ["t1", "t2"], "weights": [0.6, 0.4]}, "lines": {"l1": ["c1", "c2", "c3"], "l2": ["c4", "c2", "c1"]},
          "iron": ["c1", "c3"], "copper": ["c2", "c4"], "tph": ["tph1", "tph2"], "mills": ("tph1", "tph2"),
          "reagents": {"lime": ("reagent", 0.87, 0.97, 0, 5)}, "pebbles": ("tph2", "tph1"), "power": (["tph1"], "c4", 1000.0)}
SHIFT = {"tph": ["tph1", "tph2"], "recovery": "fa_recup_wt", "feed": "feed", "lags": {"t1": [1, 2], "fa_cuf": [1]}}
HOUR_COLUMNS = ["fa_recup_peso_l1", "fa_recup_peso_l2", "fa_recup_l1", "fa_recup_l2", "fa_recup_wt", "fa_mean_l1", "fa_delta_l1", "fa_mean_l2", "fa_delta_l2",
                "fa_fe_cu", "fa_tph_total", "fa_mill_tph_ratio", "fa_mill_tph_total", "fa_dose_lime", "fa_pebbles", "fa_specific_power"]


def _base(spark, sf_dir):
    panel = _asset_hourly(spark, sf_dir)
    return panel.select("asset", "pos", *[F.expr(v).alias(k) for k, v in BASE.items()])


def _hour_sql() -> str:
    """CTEs up to ``hours``, the hourly bundle unrounded."""
    def fill(c):
        w = "(PARTITION BY asset ORDER BY pos)"
        return f"coalesce({c}, lag({c}, 1) OVER {w}, lead({c}, 1) OVER {w}, lead({c}, 2) OVER {w}) AS f_{c}"
    rec = lambda t: s_cut(s_div(f"f_conc * (f - {t})", f"f * (f_conc - {t})"), 0, 1)
    pull = lambda t: s_cut(s_div(f"f - {t}", f"f_conc - {t}"), 0, 1)
    share = s_div("tph2", "tph1", 0)
    cols = {"fa_recup_peso_l1": pull("x1"), "fa_recup_peso_l2": pull("x2"), "fa_recup_l1": rec("x1"), "fa_recup_l2": rec("x2"),
            "fa_recup_wt": rec("(0.0 + x1 * 0.6 + x2 * 0.4)"),
            "fa_mean_l1": s_rmean([s_cut(c, 1, 50) for c in ("c1", "c2", "c3")]), "fa_delta_l1": "c2 - c1",
            "fa_mean_l2": s_rmean([s_cut(c, 1, 50) for c in ("c4", "c2", "c1")]), "fa_delta_l2": "c2 - c4",
            "fa_fe_cu": s_cut(s_div(s_rmean(["c1", "c3"]), s_rmean(["c2", "c4"])), 0, 5),
            "fa_tph_total": s_rsum(["tph1", "tph2"]), "fa_mill_tph_ratio": s_div("tph1", "tph2"), "fa_mill_tph_total": s_rsum(["tph1", "tph2"]),
            "fa_dose_lime": s_cut(s_div(f"reagent * {0.87 * 60.0!r}", f"{s_rsum(['tph1', 'tph2'])} * 0.97"), 0, 5),
            "fa_pebbles": f"(CASE WHEN {share} > 1 THEN 0.0 ELSE {share} END)",
            "fa_specific_power": s_div(s_rsum(["tph1"]), "c4 * 1000.0", 0)}
    return f"""ev AS (SELECT (user_id % 8)::INTEGER AS asset, {sql_bin_left("ts", 3600)} AS ts, event_type, value FROM events),
h AS (SELECT asset, ts, {", ".join(f"avg(value) FILTER (WHERE event_type = '{s}') AS {s}" for s in HOURLY)} FROM ev GROUP BY 1, 2),
b AS (SELECT min(ts) AS lo, max(ts) AS hi FROM ev),
panel AS (SELECT a.asset, p.pos, (SELECT lo FROM b) + to_hours(CAST(p.pos AS BIGINT)) AS ts FROM (SELECT DISTINCT asset FROM ev) a,
          (SELECT range AS pos FROM range(0, (SELECT CAST(epoch(hi - lo) / 3600 AS BIGINT) + 1 FROM b))) p),
base AS (SELECT panel.asset, panel.pos, {", ".join(f"{v} AS {k}" for k, v in BASE.items())} FROM panel LEFT JOIN h ON h.asset = panel.asset AND h.ts = panel.ts),
fills AS (SELECT *, {", ".join(fill(c) for c in ("conc", "feed", "t1", "t2"))} FROM base),
cuts AS (SELECT *, {s_cut("f_feed", 0.5, 2.0)} AS f, {s_cut("f_t1", 0.02, 0.4)} AS x1, {s_cut("f_t2", 0.02, 0.4)} AS x2 FROM fills),
hours AS (SELECT *, {", ".join(f"{v} AS {k}" for k, v in cols.items())} FROM cuts)"""


@register("feature_bundle_hour", f"WITH {_hour_sql()} SELECT asset, pos, {', '.join(f'{sql_r(c)} AS {c}' for c in HOUR_COLUMNS)} FROM hours")
def feature_bundle_hour(spark, sf_dir):
    """FEA17 by hour from specs: CLN8, then FEA6; FEA3–FEA5, FEA10–FEA14 of one line, eight assets at once."""
    out = S.compile_features(_base(spark, sf_dir), S.hourly_bundle(PARAMS, "fa"), ["asset"], "pos", BUCKET, keep=HOUR_COLUMNS)
    return finish(out.select("asset", "pos", *HOUR_COLUMNS))


def _shift_sql() -> str:
    w = "(PARTITION BY asset ORDER BY pos)"
    frame = "(PARTITION BY asset ORDER BY pos ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"
    d = 0.5 ** 0.5
    mean = (f"sum(CASE WHEN fa_cuf IS NOT NULL THEN fa_cuf * pow({d!r}, -pos) END) OVER {w} / "
            f"nullif(sum(CASE WHEN fa_cuf IS NOT NULL THEN pow({d!r}, -pos) END) OVER {w}, 0)")
    return f"""WITH {_hour_sql()},
s AS (SELECT asset, pos // 12 AS pos, {", ".join(f"avg({c}) AS {c}" for c in ("tph1", "tph2", "feed", "t1", "fa_recup_wt"))} FROM hours GROUP BY 1, 2),
c AS (SELECT *, {s_rsum(["tph1", "tph2"])} * fa_recup_wt * feed / 100.0 AS fa_cuf FROM s),
e AS (SELECT *, {mean} AS cuf_mean, CASE WHEN count(fa_cuf) OVER {frame} = 4 THEN avg(fa_cuf) OVER {frame} END AS cuf_4 FROM c),
t AS (SELECT *, {s_div("cuf_4", "cuf_mean")} AS trend FROM e)
SELECT asset, CAST(pos AS BIGINT) AS pos, {sql_r("fa_cuf")} AS fa_cuf, {sql_r(f"lag(t1, 1) OVER {w}")} AS t1_lag_1, {sql_r(f"lag(t1, 2) OVER {w}")} AS t1_lag_2,
  {sql_r(f"lag(fa_cuf, 1) OVER {w}")} AS fa_cuf_lag_1, {sql_r("cuf_mean")} AS cuf_mean, {sql_r("cuf_4")} AS cuf_4, {sql_r(f"lag(trend, 3) OVER {w}")} AS trend_lag
FROM t"""


@register("feature_bundle_shift", _shift_sql())
def feature_bundle_shift(spark, sf_dir):
    """FEA17 by shift: hourly bundle, shift means, then fine copper, lags, and a chain of windows upon windows."""
    hours = S.compile_features(_base(spark, sf_dir), S.hourly_bundle(PARAMS, "fa"), ["asset"], "pos", BUCKET)
    means = [F.avg(c).alias(c) for c in ("tph1", "tph2", "feed", "t1", "fa_recup_wt")]
    shifts = hours.groupBy("asset", F.expr("pos div 12").alias("pos")).agg(*means)
    chain = [S.weighted_mean("cuf_mean", "fa_cuf", 2.0), S.rolling("cuf_4", "fa_cuf", 4),
             S.row("trend", ["cuf_4", "cuf_mean"], lambda: F.try_divide("cuf_4", "cuf_mean")), S.lagged("trend_lag", "trend", 3)]
    out = S.compile_features(shifts, S.shift_bundle(SHIFT, "fa") + chain, ["asset"], "pos", BUCKET)
    return finish(out.select("asset", "pos", "fa_cuf", "t1_lag_1", "t1_lag_2", "fa_cuf_lag_1", "cuf_mean", "cuf_4", "trend_lag"))


# ------------------------------------------------------------------ plant KPIs
# plant tags from lineitem; every third line lacks one mill's power, every fifth one gate
TAGS = {"mill1": "l_quantity * 40.0", "mill2": "l_extendedprice / 50.0", "conv1": "l_discount * 9000.0", "conv2": "l_tax * 6000.0", "grade1": "0.6 + 10.0 * l_tax",
        "grade2": "0.5 + 8.0 * l_discount", "tail": "0.02 + 3.0 * l_discount", "conc": "20.0 + l_quantity / 5.0", "fine1": "l_tax * 100.0",
        "fine2": "CASE WHEN l_linenumber <> 2 THEN l_discount * 200.0 END", "mw": "l_quantity / 3.0", "kw": "CASE WHEN l_linenumber % 3 <> 0 THEN l_extendedprice / 5.0 END",
        "flow1": "l_quantity * 9.0", "flow2": "CASE WHEN l_linenumber % 4 <> 0 THEN l_extendedprice / 100.0 END", "flow3": "l_tax * 900.0",
        "gate": "CASE WHEN l_linenumber % 5 = 0 THEN NULL WHEN l_tax > 0.04 THEN 1.0 ELSE 0.0 END", "taken": "l_quantity * 10.0",
        "added": "CASE WHEN l_linenumber <> 6 THEN l_discount * 500.0 END", "level1": "l_quantity * 2.0", "level2": "CASE WHEN l_linenumber % 2 = 0 THEN l_tax * 900.0 END"}
KPI = {"sag": ("mill1", "mill2"), "conventional": ["conv1", "conv2"], "feed_grades": ("grade1", "grade2"), "sieves": {"100": ("fine1", "fine2"), "65": ("fine2", "fine1")},
       "tails": "tail", "conc": "conc", "power": ("mw", "kw"), "solids_sag": ["level1", "fine2"], "solids_conventional": ["fine1", "fine2"],
       "supply": ["flow1", "flow2", "flow3"], "water_sag": ["flow1", "flow2"], "water_conventional": ["flow3", "flow2"], "litres_sag": ["flow3"],
       "litres_conventional": ["flow2"], "fresh": ["flow1", "flow2", "flow3"], "fresh_out": ["level2"], "gated": ("flow1", "gate"), "corrected": ("taken", "added"),
       "levels_sag": ["level1"], "levels_conventional": ["level2", "fine2"], "river": ("flow1", "flow2"), "reservoir": "level2"}
KPIS = ["tph_sag", "tph_conventional", "tph_total", "feed_grade", "recovery", "fine_copper", "power_sag", "energy_intensity", "solids_sag", "solids_conventional",
        "water_supply", "water_sag", "water_conventional", "water_total", "fresh_water", "makeup", "river_flow", "level_sag", "level_conventional", "level_recovered",
        "reservoir_volume", "sieve_100", "sieve_65", "water_intensity_sag", "water_intensity_conventional", "water_intensity_total"]


def _kpi_sql() -> str:
    mix = lambda x, y: s_div(f"{x} * mill1 + {y} * mill2", "mill1 + mill2")
    gated = "CASE WHEN coalesce(gate > 0, false) THEN 0.0 ELSE flow1 END"
    back = "(CASE WHEN abs(taken) > 400 THEN 0.0 ELSE -taken END + added)"
    first = {"tph_sag": "mill1 + mill2", "tph_conventional": s_rsum(["conv1", "conv2"]), "raw": mix("grade1", "grade2"),
             "power_sag": "(mw + kw / 1000.0) / 2.0", "solids_sag": s_rmean(["level1", "fine2"]), "solids_conventional": s_rmean(["fine1", "fine2"]),
             "water_supply": s_rsum(["flow1", "flow2", "flow3"]), "water_sag": f"{s_rsum(['flow1', 'flow2'])} + {s_rsum(['flow3'])} * 3.6",
             "water_conventional": f"{s_rsum(['flow3', 'flow2'])} + {s_rsum(['flow2'])} * 3.6",
             "fresh_water": f"({s_rsum(['flow1', 'flow2', 'flow3'])} - {s_rsum(['level2'])} + {s_rsum([f'({gated})', back])}) * 3.6",
             "river_flow": "flow1 + flow2", "level_sag": s_rmean(["level1"]), "level_conventional": s_rmean(["level2", "fine2"]),
             "level_recovered": s_rmean(["level1", "level2", "fine2"]), "reservoir_volume": "level2", "sieve_100": mix("fine1", "fine2"), "sieve_65": mix("fine2", "fine1")}
    second = {"tph_total": "tph_sag + tph_conventional", "feed_grade": s_cut("raw", 0.7, 1.3), "recovery": s_div("(raw - tail) * conc", "(conc - tail) * raw"),
              "energy_intensity": s_div("power_sag", "tph_sag"), "water_total": "water_sag + water_conventional",
              "water_intensity_sag": s_div("water_sag", "tph_sag"), "water_intensity_conventional": s_div("water_conventional", "tph_conventional")}
    third = {"fine_copper": "recovery * feed_grade * tph_sag / 100.0", "makeup": s_div("fresh_water", "tph_total"), "water_intensity_total": s_div("water_total", "tph_total")}
    layer = lambda cols, of: f"(SELECT *, {', '.join(f'{v} AS {k}' for k, v in cols.items())} FROM {of})"
    return f"""WITH m AS (SELECT l_orderkey, l_linenumber, {", ".join(f"{v} AS {k}" for k, v in TAGS.items())} FROM lineitem),
a AS {layer(first, "m")}, b AS {layer(second, "a")}, c AS {layer(third, "b")}
SELECT l_orderkey, l_linenumber, {", ".join(f"{sql_r(k)} AS {k}" for k in KPIS)} FROM c
WHERE fresh_water > 1000 AND fresh_water < 8000 AND tph_total > 1500 AND tph_sag > 900 AND makeup > 0.4 AND makeup < 1.8"""


@register("plant_kpis", _kpi_sql())
def plant_kpis(spark, sf_dir):
    """FEA23: 26 KPIs of the plant in one stage without a shuffle, then the filter of normal operation."""
    tags = FX.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *[F.expr(v).alias(k) for k, v in TAGS.items()])
    out = S.compile_features(tags, S.plant_kpis(KPI), [], "pos")
    # one row made of the finished KPIs: the filter reads them, instead of working them out again
    out = out.select("l_orderkey", "l_linenumber", F.inline(F.array(F.struct(*KPIS))))
    return finish(out.where(S.operating()))


BLEND = {"status": "status", "scale": "click", "open": "open_", "near": "view", "recycled": "back"}
BLEND_COLUMNS = ["mill_open", "mill_recycled", "mill_under", "mill_total", "mill_open_share", "mill_recycled_share", "mill_under_share"]


def _blend_sql() -> str:
    cut = lambda c: f"CASE WHEN {c} < 0 THEN 0.0 ELSE {c} END"
    w = "(PARTITION BY asset ORDER BY pos)"
    total = s_rsum(["o", "r", "u"])
    return f"""WITH {_hour_sql()},
s AS (SELECT panel.asset, panel.pos // 8 AS pos, avg(click) AS click, avg(view) AS view FROM panel LEFT JOIN h ON h.asset = panel.asset AND h.ts = panel.ts GROUP BY 1, 2),
f AS (SELECT asset, pos, CASE WHEN pos % 5 = 0 THEN 0.0 ELSE 1.0 END AS status, click, view, click * 0.4 AS open_, CASE WHEN pos % 3 > 0 THEN view * 0.7 - 20.0 END AS back FROM s),
g AS (SELECT *, status * click AS far, status * open_ AS far_open FROM f),
l AS (SELECT asset, pos, {cut(f"(view - coalesce(back, 0.0) + lag(far_open, 2) OVER {w})")} AS o, {cut("coalesce(back, 0.0)")} AS r, {cut(f"(lag(far - far_open, 2) OVER {w})")} AS u FROM g)
SELECT asset, CAST(pos AS BIGINT) AS pos, {sql_r("o")} AS mill_open, {sql_r("r")} AS mill_recycled, {sql_r("u")} AS mill_under, {sql_r(total)} AS mill_total,
  {sql_r(s_div("o", total))} AS mill_open_share, {sql_r(s_div("r", total))} AS mill_recycled_share, {sql_r(s_div("u", total))} AS mill_under_share FROM l"""


@register("blend_shares", _blend_sql())
def blend_shares(spark, sf_dir):
    """FEA25: a mill's feed by source on eight-hour rows, the far belt's ore two rows later."""
    panel = _asset_hourly(spark, sf_dir)
    rows = panel.groupBy("asset", F.expr("pos div 8").alias("pos")).agg(F.avg("click").alias("click"), F.avg("view").alias("view"))
    rows = rows.withColumns({"status": F.when(F.col("pos") % 5 == 0, 0.0).otherwise(1.0), "open_": F.col("click") * 0.4,
                             "back": F.when(F.col("pos") % 3 > 0, F.col("view") * 0.7 - 20.0)})
    return finish(S.compile_features(rows, S.blend_features(BLEND, "mill"), ["asset"], "pos", BUCKET).select("asset", "pos", *BLEND_COLUMNS))
