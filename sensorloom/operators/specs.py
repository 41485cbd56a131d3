"""Feature bundles from specs (FEA17) and the plant KPIs (FEA23).

A :class:`Feature` names its output, the columns it reads and how it is made: from the
row, from a window of bounded reach, or as an exponentially weighted mean.
:func:`compile_features` orders the features by their inputs and lays them out in
passes.  A pass holds the row features that are ready, level by level, then **all**
ready windows in one halo pass and **all** ready weighted means in one carry scan.
The number of shuffles is that of the longest chain of windows upon windows, whatever
the number of features.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from sensorloom.functions.exprs import col, cut, magnitude_gate, non_negative, row_mean, row_sum, safe_div, weighted_avg, zero_while
from sensorloom.operators import features as FE
from sensorloom.operators import windows as W


@dataclass(frozen=True)
class Feature:
    """One column to be made.  ``make`` takes no argument for a row feature and the window spec for a window."""

    name: str
    inputs: tuple[str, ...]
    make: Callable[..., Column] | None = None
    back: int = 0
    fwd: int = 0
    halflife: float | None = None

    @property
    def kind(self) -> str:
        return "mean" if self.halflife is not None else "window" if self.back or self.fwd else "row"


def row(name: str, inputs: Sequence[str], make: Callable[[], Column]) -> Feature:
    return Feature(name, tuple(inputs), make)


def window(name: str, inputs: Sequence[str], make: Callable[[WindowSpec], Column], back: int = 0, fwd: int = 0) -> Feature:
    if not (back or fwd):
        raise ValueError(f"{name}: a window reaches at least one row")
    return Feature(name, tuple(inputs), make, back, fwd)


def weighted_mean(name: str, source: str, halflife: float) -> Feature:
    """WIN5 of ``source``."""
    return Feature(name, (source,), halflife=float(halflife))


def lagged(name: str, source: str, n: int) -> Feature:
    return window(name, [source], lambda w: F.lag(source, n).over(w), back=n)


def rolling(name: str, source: str, n: int, dead: int = 0) -> Feature:
    """WIN3 of ``source``, ``dead`` rows ago (WIN7)."""
    return window(name, [source], lambda w: W.rolling_full_mean(source, n, w, dead), back=n - 1 + dead)


def filled(name: str, source: str, ffill: int = 1, bfill: int = 2) -> Feature:
    """CLN8 of ``source``."""
    return window(name, [source], lambda w: W.limited_fill(source, w, ffill, bfill), ffill, bfill)


def passes(features: Sequence[Feature], columns: Sequence[str]) -> list[tuple[list[list[Feature]], list[Feature], list[Feature]]]:
    """The layout: per pass the levels of row features, the windows and the weighted means.

    Raises on a name that is made twice, an input that is nowhere, or features that need each other."""
    names = [f.name for f in features]
    if twice := {n for n in names if names.count(n) > 1 or n in columns}:
        raise ValueError(f"made twice: {sorted(twice)}")
    if missing := {i for f in features for i in f.inputs} - set(columns) - set(names):
        raise ValueError(f"no such input: {sorted(missing)}")
    known, left, out = set(columns), list(features), []
    while left:
        levels = []
        while ready := [f for f in left if f.kind == "row" and known.issuperset(f.inputs)]:
            levels.append(ready)
            known |= {f.name for f in ready}
            left = [f for f in left if f.name not in known]
        ready = [f for f in left if known.issuperset(f.inputs)]
        if left and not ready:
            raise ValueError(f"features that need each other: {sorted(f.name for f in left)}")
        out.append((levels, [f for f in ready if f.kind == "window"], [f for f in ready if f.kind == "mean"]))
        known |= {f.name for f in ready}
        left = [f for f in left if f.name not in known]
    return out


def compile_features(df: DataFrame, features: Sequence[Feature], keys: Sequence[str], pos_col: str,
                     bucket_rows: int = W.DEFAULT_BUCKET_ROWS, keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` with all ``features``; with ``keep`` only the input's columns and those features.

    ``pos_col`` is dense per ``keys``; it is not read where no feature is a window."""
    out = df
    for levels, windows, means in passes(features, df.columns):
        for level in levels:
            out = out.select("*", *[f.make().alias(f.name) for f in level])
        if means:
            out = W.ewm_means(out, keys, pos_col, [(f.inputs[0], f.halflife, f.name) for f in means], bucket_rows)
        if windows:
            back, fwd = max(f.back for f in windows), max(f.fwd for f in windows)
            out = W.positional(out, keys, pos_col, lambda w, fs=windows: {f.name: f.make(w) for f in fs}, back, fwd, max(bucket_rows, back, fwd))
    return out if keep is None else out.select(*df.columns, *keep)


# ------------------------------------------------------------------ bundles
def flotation_features(conc: str, feed: str, tails: Sequence[str], weights: Sequence[float], prefix: str,
                       feed_range=(0.5, 2.0), tail_range=(0.02, 0.4)) -> list[Feature]:
    """FEA6 with its CLN8 fill: mass pull and recovery per line, and of the weighted tails."""
    def part(name: str) -> str:
        return f"_{prefix}_{name}"
    out = [filled(part(f"fill_{c}"), c) for c in (conc, feed, *tails)]
    c, f = part(f"fill_{conc}"), part("feed")
    out.append(row(f, [part(f"fill_{feed}")], lambda: cut(part(f"fill_{feed}"), *feed_range)))
    for t in tails:
        out.append(row(part(t), [part(f"fill_{t}")], lambda t=t: cut(part(f"fill_{t}"), *tail_range)))
    ts = [part(t) for t in tails]
    mixed = part("tails")
    out.append(row(mixed, ts, lambda: sum((F.col(t) * F.lit(float(w)) for t, w in zip(ts, weights)), F.lit(0.0))))

    def ratio(name: str, tail: str, recovery: bool) -> list[Feature]:
        raw = f"_{name}"

        def make() -> Column:
            won, rest = col(f) - col(tail), col(c) - col(tail)
            return safe_div(col(c) * won, col(f) * rest) if recovery else safe_div(won, rest)
        return [row(raw, [c, f, tail], make), row(name, [raw], lambda: cut(raw, 0, 1))]
    for i, t in enumerate(ts):
        out += ratio(f"{prefix}_recup_peso_l{i + 1}", t, False) + ratio(f"{prefix}_recup_l{i + 1}", t, True)
    return out + ratio(f"{prefix}_recup_wt", mixed, True)


def line_features(lines: Mapping[str, Sequence[str]], prefix: str, lo: float = 1, hi: float = 50) -> list[Feature]:
    """FEA3 and FEA4 of every named line of cells."""
    out = []
    for name, cells in lines.items():
        out.append(row(f"{prefix}_mean_{name}", cells, lambda cells=cells: FE.mean_by_line(cells, lo, hi)))
        out.append(row(f"{prefix}_delta_{name}", cells, lambda cells=cells: FE.delta_first_penultimate(cells)))
    return out


def hourly_bundle(p: Mapping, prefix: str) -> list[Feature]:
    """FEA17 by hour: the features of one line of the plant that ``p`` names parameters for.

    ``flotation`` (conc, feed, tails, weights), ``lines`` (name to cells), ``iron`` and ``copper``
    columns, ``tph`` columns, ``mills`` (a pair), ``reagents`` (name to column, density, dry
    load, range), ``pebbles`` (column, feed), ``power`` (tonnes, power, factor)."""
    out: list[Feature] = []
    if fl := p.get("flotation"):
        out += flotation_features(fl["conc"], fl["feed"], fl["tails"], fl["weights"], prefix)
    if lines := p.get("lines"):
        out += line_features(lines, prefix)
    if p.get("iron"):
        out.append(row(f"{prefix}_fe_cu", [*p["iron"], *p["copper"]], lambda: FE.fe_over_cu(p["iron"], p["copper"])))
    if p.get("tph"):
        out.append(row(f"{prefix}_tph_total", p["tph"], lambda: FE.total_tph(p["tph"])))
    if p.get("mills"):
        a, b = p["mills"]
        out += [row(f"{prefix}_mill_{n}", [a, b], lambda n=n: FE.sag_tph_targets(a, b)[n]) for n in ("tph_ratio", "tph_total")]
    for name, (reagent, density, dry, lo, hi) in p.get("reagents", {}).items():
        ratio = f"_{prefix}_{name}"
        out.append(row(ratio, [reagent, *p["tph"]], lambda r=reagent, d=density, y=dry: FE.reagent_ratio(r, p["tph"], d, y)))
        out.append(row(f"{prefix}_dose_{name}", [ratio], lambda c=ratio, lo=lo, hi=hi: cut(c, lo, hi)))
    if p.get("pebbles"):
        out.append(row(f"{prefix}_pebbles", p["pebbles"], lambda: FE.pebbles_share(*p["pebbles"])))
    if p.get("power"):
        tonnes, power, factor = p["power"]
        out.append(row(f"{prefix}_specific_power", [*tonnes, power], lambda: FE.specific_power(tonnes, power, factor)))
    return out


def shift_bundle(p: Mapping, prefix: str) -> list[Feature]:
    """FEA17 by shift: fine copper (``tph``, ``recovery``, ``feed``) and lags (``lags``: column to shifts)."""
    out: list[Feature] = []
    if p.get("recovery"):
        out.append(row(f"{prefix}_cuf", [*p["tph"], p["recovery"], p["feed"]], lambda: FE.fine_copper(p["tph"], p["recovery"], p["feed"])))
    for c, steps in p.get("lags", {}).items():
        out += [lagged(f"{c}_lag_{n}", c, n) for n in steps]
    return out


def blend_features(p: Mapping, prefix: str, lag: int = 2) -> list[Feature]:
    """FEA25: what a mill's feed is blended of, by source and as shares.

    ``p`` names ``belt`` and ``status`` with ``scale`` (the far belt's load is their product), ``open`` (open pit's part
    of it, as far as the belt runs), ``near`` (the near belt) and ``recycled`` (its part that is recycled, missing
    is 0).  The far belt's ore arrives ``lag`` rows later.  Negative amounts are 0; a share of nothing is NULL."""
    far, far_open, sources = f"_{prefix}_far", f"_{prefix}_far_open", ["open", "recycled", "under"]
    back = p["recycled"]
    raw = {n: f"_{prefix}_raw_{n}" for n in sources}
    out = [row(far, [p["status"], p["scale"]], lambda: F.col(p["status"]) * F.col(p["scale"])),
           row(far_open, [p["status"], p["open"]], lambda: F.col(p["status"]) * F.col(p["open"])),
           row(f"_{prefix}_far_under", [far, far_open], lambda: F.col(far) - F.col(far_open)),
           lagged(f"_{prefix}_open_then", far_open, lag), lagged(raw["under"], f"_{prefix}_far_under", lag),
           row(raw["recycled"], [back], lambda: F.coalesce(F.col(back), F.lit(0.0))),
           row(raw["open"], [p["near"], back, f"_{prefix}_open_then"],
               lambda: F.col(p["near"]) - F.coalesce(F.col(back), F.lit(0.0)) + F.col(f"_{prefix}_open_then"))]
    out += [row(f"{prefix}_{n}", [raw[n]], lambda n=n: non_negative(raw[n])) for n in sources]
    names = [f"{prefix}_{n}" for n in sources]
    out.append(row(f"{prefix}_total", names, lambda: row_sum(names)))
    return out + [row(f"{n}_share", [n, f"{prefix}_total"], lambda n=n: safe_div(n, f"{prefix}_total")) for n in names]


# ------------------------------------------------------------------ plant KPIs
LITRES_TO_CUBIC = 3.6  # l/s to m3/h


def plant_kpis(p: Mapping) -> list[Feature]:
    """FEA23: grades, recovery, fine copper, energy and water intensity, make-up and levels, as row features.

    ``p`` names columns: ``sag`` (two mills' tonnage), ``conventional``, ``feed_grades``, ``sieves``
    (name to a pair), ``tails``, ``conc``, ``power`` (megawatts, kilowatts), ``solids_sag``,
    ``solids_conventional``, ``supply``, ``water_sag``, ``water_conventional``, ``litres_sag``,
    ``litres_conventional`` (l/s), ``fresh`` (l/s in), ``fresh_out``, ``gated`` (flow, gate: 0
    while the gate is above 0), ``corrected`` (flow, added: minus the flow unless it is
    beyond 400), ``levels_sag``, ``levels_conventional``, ``river`` (a pair), ``reservoir``.

    Sums over groups skip NULLs; sums of two named columns and weighted means do not.
    A division by zero is NULL."""
    a, b = p["sag"]

    def litres(cs: Sequence[str]) -> Column:
        return row_sum(cs) * F.lit(LITRES_TO_CUBIC)

    def fresh_water() -> Column:
        flow, gate = p["gated"]
        taken, added = p["corrected"]
        gated = zero_while(flow, gate)
        back = magnitude_gate(-F.col(taken), 400) + F.col(added)
        total = row_sum(p["fresh"]) - row_sum(p["fresh_out"]) + row_sum([gated, back])
        return total * F.lit(LITRES_TO_CUBIC)

    def recovery() -> Column:
        f, t, c = F.col("_feed_grade"), F.col(p["tails"]), F.col(p["conc"])
        return safe_div((f - t) * c, (c - t) * f)
    out = [
        row("tph_sag", [a, b], lambda: F.col(a) + F.col(b)),
        row("tph_conventional", p["conventional"], lambda: row_sum(p["conventional"])),
        row("tph_total", ["tph_sag", "tph_conventional"], lambda: F.col("tph_sag") + F.col("tph_conventional")),
        row("_feed_grade", [a, b, *p["feed_grades"]], lambda: weighted_avg(p["feed_grades"], [a, b])),
        row("feed_grade", ["_feed_grade"], lambda: cut("_feed_grade", 0.7, 1.3)),
        row("recovery", ["_feed_grade", p["tails"], p["conc"]], recovery),
        row("fine_copper", ["recovery", "feed_grade", "tph_sag"], lambda: F.col("recovery") * F.col("feed_grade") * F.col("tph_sag") / F.lit(100.0)),
        row("power_sag", p["power"], lambda: (F.col(p["power"][0]) + F.col(p["power"][1]) / F.lit(1000.0)) / F.lit(2.0)),
        row("energy_intensity", ["power_sag", "tph_sag"], lambda: safe_div("power_sag", "tph_sag")),
        row("solids_sag", p["solids_sag"], lambda: row_mean(p["solids_sag"])),
        row("solids_conventional", p["solids_conventional"], lambda: row_mean(p["solids_conventional"])),
        row("water_supply", p["supply"], lambda: row_sum(p["supply"])),
        row("water_sag", [*p["water_sag"], *p["litres_sag"]], lambda: row_sum(p["water_sag"]) + litres(p["litres_sag"])),
        row("water_conventional", [*p["water_conventional"], *p["litres_conventional"]],
            lambda: row_sum(p["water_conventional"]) + litres(p["litres_conventional"])),
        row("water_total", ["water_sag", "water_conventional"], lambda: F.col("water_sag") + F.col("water_conventional")),
        row("fresh_water", [*p["fresh"], *p["fresh_out"], *p["gated"], *p["corrected"]], fresh_water),
        row("makeup", ["fresh_water", "tph_total"], lambda: safe_div("fresh_water", "tph_total")),
        row("river_flow", p["river"], lambda: F.col(p["river"][0]) + F.col(p["river"][1])),
        row("level_sag", p["levels_sag"], lambda: row_mean(p["levels_sag"])),
        row("level_conventional", p["levels_conventional"], lambda: row_mean(p["levels_conventional"])),
        row("level_recovered", [*p["levels_sag"], *p["levels_conventional"]], lambda: row_mean([*p["levels_sag"], *p["levels_conventional"]])),
        row("reservoir_volume", [p["reservoir"]], lambda: F.col(p["reservoir"])),
    ]
    out += [row(f"sieve_{n}", [a, b, *pair], lambda pair=pair: weighted_avg(pair, [a, b])) for n, pair in p["sieves"].items()]
    out += [row(f"water_intensity_{n}", [f"water_{n}", f"tph_{n}"], lambda n=n: safe_div(f"water_{n}", f"tph_{n}")) for n in ("sag", "conventional", "total")]
    return out


def operating(fresh=(1000.0, 8000.0), least_total: float = 1500.0, least_sag: float = 900.0, makeup=(0.4, 1.8)) -> Column:
    """FEA23's filter of normal operation: open ranges, and NULL is out."""
    return ((F.col("fresh_water") > fresh[0]) & (F.col("fresh_water") < fresh[1]) & (F.col("tph_total") > least_total)
            & (F.col("tph_sag") > least_sag) & (F.col("makeup") > makeup[0]) & (F.col("makeup") < makeup[1]))
