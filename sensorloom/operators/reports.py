"""Report, hand-over and chained-model operators (SRT1, SRT2, LIM2, SET2, AGG16, AGG19, JOI13–JOI15,
ML3, ML11, ML12, FEA16, FEA26, OPT4)."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.exprs import row_sum, safe_div
from sensorloom.operators import features as FE
from sensorloom.operators import filters as FL
from sensorloom.operators import ml as M
from sensorloom.operators import windows as W
from sensorloom.operators.quantiles import exact_quantiles, running_counts

Model = Callable[[DataFrame], Column]


# ------------------------------------------------------------------ order, ends, sets
def descents(df: DataFrame, keys: Sequence[str], pos_col: str, ts_col: str = "ts", bucket_rows: int = W.DEFAULT_BUCKET_ROWS) -> DataFrame:
    """SRT1: the rows whose time is before that of the row ahead of them (``pos_col`` is the ingest position)."""
    d = W.positional(df, keys, pos_col, lambda w: {"_prev": F.lag(ts_col).over(w)}, back=1, bucket_rows=bucket_rows)
    return d.where(F.col(ts_col) < F.col("_prev")).drop("_prev")


def assert_ascending(df: DataFrame, keys: Sequence[str], pos_col: str, ts_col: str = "ts", bucket_rows: int = W.DEFAULT_BUCKET_ROWS) -> None:
    """SRT1: raise unless time ascends with the ingest position."""
    if not descents(df, keys, pos_col, ts_col, bucket_rows).isEmpty():
        raise ValueError(f"{ts_col} does not ascend")


def ordered(df: DataFrame, *cols: str) -> DataFrame:
    """SRT2: a result table in its reading order; only for the last step, small or written by range."""
    return df.orderBy(*cols)


def drop_last_rows(df: DataFrame, n: int, ts_col: str = "ts") -> DataFrame:
    """LIM2: without the ``n`` rows of the latest times (times are unique)."""
    last = df.select(ts_col).orderBy(F.col(ts_col).desc()).limit(n)
    return df.join(last, ts_col, "left_anti")


def append_keep_last(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SET2: ``second`` appended to ``first``; of rows with one key that of ``second`` stays."""
    both = first.withColumn("_o", F.lit(0)).unionByName(second.withColumn("_o", F.lit(1)))
    return FL.dedupe(both, keys, "_o", keep="last").drop("_o")


# ------------------------------------------------------------------ joins of the hand-over
def lookup_rows(rows: DataFrame, data: DataFrame, run_col: str = "run_id", ts_col: str = "ts") -> DataFrame:
    """JOI13: each row with its input row, by run and time."""
    return rows.join(data, [run_col, ts_col])


def attach_attributes(rows: DataFrame, td: DataFrame, attributes: Sequence[str] = ("description", "area", "tag_type"), tag_col: str = "tag_id") -> DataFrame:
    """JOI14: dictionary attributes beside each control row; unknown tags keep NULL."""
    return rows.join(td.select(F.col("tag").alias(tag_col), *attributes), tag_col, "left")


def aligned(left: DataFrame, right: DataFrame, key: str = "ts") -> DataFrame:
    """JOI15: two tables side by side on their index; a key of one side only keeps its row."""
    return left.join(right, key, "full")


# ------------------------------------------------------------------ summaries
def uplift_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG16: ``metric, n, mean, std, min, p25, median, p75, max`` of each column."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("v")) for c in cols])).alias("x")).select("x.*")
    base = long.groupBy("metric").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"))
    q = exact_quantiles(long, ["metric"], "v", [0.0, 0.25, 0.5, 0.75, 1.0])
    return base.join(q.withColumnsRenamed({"q0": "min", "q1": "p25", "q2": "median", "q3": "p75", "q4": "max"}), "metric", "left")


def mean_ratio_screen(long: DataFrame, cut: datetime, lo: float = 0.9, hi: float = 1.1, ts_col: str = "ts") -> DataFrame:
    """AGG19: per tag the mean before a date over the mean from it on, flagged outside ``[lo, hi]``."""
    before = F.col(ts_col) < F.lit(cut).cast("timestamp_ntz")
    m = long.groupBy("tag").agg(F.avg(F.when(before, F.col("value"))).alias("mean_before"), F.avg(F.when(~before, F.col("value"))).alias("mean_after"))
    m = m.withColumn("ratio", safe_div("mean_before", "mean_after"))
    return m.withColumn("drifted", ~F.col("ratio").between(lo, hi))


# ------------------------------------------------------------------ model tables
def split_xy(train: DataFrame, test: DataFrame, features: Sequence[str], target: str, ts_col: str = "ts", own_quantile: float | None = None,
             train_ranges: tuple | None = None) -> DataFrame:
    """ML3: ``split, ts, features…, target`` of both splits without rows that lack the target.

    The training part may be kept above its target's own quantile (FLT14) and
    to two date ranges (FLT15); a time in both splits belongs to the test (SET2)."""
    train, test = (d.select(ts_col, *features, target).where(F.col(target).isNotNull()) for d in (train, test))
    if own_quantile is not None:
        train = FL.above_own_quantile(train, target, own_quantile)
    if train_ranges is not None:
        train = FL.two_date_ranges(train, *train_ranges, ts_col=ts_col)
    both = append_keep_last(train.withColumn("split", F.lit("train")), test.withColumn("split", F.lit("test")), [ts_col])
    return both.select("split", ts_col, *features, target)


def score_splits(df: DataFrame, targets: Mapping[str, str], split_col: str = "split") -> DataFrame:
    """ML11: the regression metrics of each ``target: prediction`` by split, with mean and spread of the target."""
    long = df.select(split_col, F.explode(F.array(*[F.struct(F.lit(y).alias("target"), F.col(y).cast("double").alias("y"),
                                                             F.col(p).cast("double").alias("yhat")) for y, p in targets.items()])).alias("x"))
    long = long.select(split_col, "x.*").where(F.col("y").isNotNull() & F.col("yhat").isNotNull())
    spread = long.groupBy(split_col, "target").agg(F.stddev_samp("y").alias("std_true"))
    return M.regression_metrics(long, "y", "yhat", [split_col, "target"]).join(spread, [split_col, "target"])


def score_recovery(df: DataFrame, actual: str, conc: str, feed: str, tails: str, lag: str | None = None, split_col: str = "split") -> DataFrame:
    """ML11: metrics of the recovery that follows from predicted tails, by split.

    ``tails`` is the prediction, or with ``lag`` the predicted change of that column.  The recovery is
    ``c(f − t) / (f(c − t))``; a division by zero leaves the row out."""
    t = F.col(tails) if lag is None else F.col(lag) + F.col(tails)
    f, c = F.col(feed), F.col(conc)
    rows = df.withColumn("_t", t).withColumn("_recovery", safe_div((f - F.col("_t")) * c, (c - F.col("_t")) * f))
    return score_splits(rows, {actual: "_recovery"}, split_col)


def normal_quantile_sql(p: str) -> str:
    """The standard normal quantile of ``p`` in (0, 1) as a SQL expression: Acklam's rational approximation."""
    # fixed values: the coefficients of that approximation
    a = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
    b = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01, -1.328068155288572e+01, 1.0]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00, 1.0]

    def poly(k, x):
        out = f"CAST({k[0]!r} AS DOUBLE)"
        for v in k[1:]:
            out = f"({out} * {x} + CAST({v!r} AS DOUBLE))"
        return out

    def tail(q):
        x = f"sqrt(CAST(-2.0 AS DOUBLE) * ln({q}))"
        return f"{poly(c, x)} / {poly(d, x)}"
    m = f"({p} - CAST(0.5 AS DOUBLE))"
    r = f"({m} * {m})"
    return (f"(CASE WHEN {p} < 0.02425 THEN {tail(p)} WHEN {p} > 0.97575 THEN -({tail(f'(1 - {p})')}) "
            f"ELSE {m} * {poly(a, r)} / {poly(b, r)} END)")


def qq_points(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """ML12: per key and distinct value its count, middle rank as a probability and the normal quantile there."""
    rows = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    rows = running_counts(rows, keys, value, ["n"])
    p = ((F.col("cum_n") - F.col("n") * 0.5) / F.col("all_n")).alias("p")
    return rows.select(*keys, value, "n", p).withColumn("theoretical", F.expr(normal_quantile_sql("p")))


# ------------------------------------------------------------------ domain features
def mill_filling(df: DataFrame, tags: Mapping[str, str], const: Mapping[str, float], slopes: Sequence[float], name: str, pos_col: str = "pos",
                 bucket_rows: int = W.DEFAULT_BUCKET_ROWS) -> DataFrame:
    """FEA16 (+ CLN9): ball filling (jb) and total filling (jc) of a mill from speed, pressure, solids and power.

    ``tags`` names the columns of ``velocidad, presion, presion_hl, cp, potencia``;
    one pair of results per slope of filling over pressure.  Invalid rows are NULL
    and then take the last valid value; from the second slope on the inputs
    are forward filled as well."""
    k = dict(const)
    diameter = k["k1"] / k["k2"] * k["k2"]
    length = k["k3"] / k["k2"] * k["k2"]
    power_factor = k["k7"] * diameter ** k["k12"] * length * math.sin(k["k13"] / k["k14"] * math.pi)
    inputs = list(tags.values())
    keyed = df.withColumn("_one", F.lit(0))
    filled = W.ffill(keyed, ["_one"], pos_col, inputs, bucket_rows).select(pos_col, *[F.col(c).alias(f"_f_{c}") for c in inputs])
    d = keyed.join(filled, pos_col)
    out = []
    for i, slope in enumerate(slopes):
        x = {n: F.col(c if i == 0 else f"_f_{c}") for n, c in tags.items()}
        jc, load, pulp, jb = f"_jc{i}", f"_load{i}", f"_pulp{i}", f"_jb{i}"
        # in steps, so that each formula is written out once
        d = d.withColumns({jc: F.lit(slope) * x["presion"] + (F.lit(k["jc_ideal"]) - F.lit(slope) * x["presion_hl"]),
                           pulp: 1 / (x["cp"] / k["k10"] / k["k9"] + (1 - x["cp"] / k["k9"])),
                           f"_nc{i}": x["velocidad"] / k["k6"] * math.sqrt(diameter) * k["k9"]})
        share = F.col(jc) / k["k9"]
        d = d.withColumn(load, F.lit(power_factor) * share * (1 - k["k8"] * share) * F.col(f"_nc{i}") / k["k9"])
        d = d.withColumn(load, F.when(F.col(load) > k["k9"], F.col(load)))
        density = x["potencia"] * k["k15"] * k["k16"] / F.col(load)
        steel = k["k11"] - k["k10"]
        raw = (share * density - F.col(pulp) * (share * k["k17"]) * k["Jfill"]) / k["k18"] / steel - k["k10"] * share / steel
        d = d.withColumn(jb, raw)
        valid = (x["cp"].between(k["min_sol"], k["max_sol"]) & (x["potencia"] >= k["min_pot"]) & (x["velocidad"] >= k["min_vel"])
                 & x["presion"].between(k["min_pres"], k["max_pres"]) & (F.col(jb) > k["min_jb"]))
        label = f"{name}_m_jc_{str(slope).replace('.', '_')}"
        d = d.withColumns({f"{label}_jb": F.when(valid, F.col(jb)), f"{label}_jc": F.col(jc)})
        out += [f"{label}_jb", f"{label}_jc"]
    d = d.select(*df.columns, "_one", *out)
    return W.ffill(d, ["_one"], pos_col, out, bucket_rows).select(*df.columns, *out)


def relining_stamps(df: DataFrame, name_col: str, text_col: str, order_col: str, formats: Sequence[str]) -> DataFrame:
    """FEA26: one row per name, the last in ``order_col``, with its time text parsed by the first format that fits."""
    one = FL.dedupe(df, [name_col], order_col, keep="last")
    return one.withColumn("stamp", F.coalesce(*[F.try_to_timestamp(F.col(text_col), F.lit(f)) for f in formats]).cast("timestamp_ntz"))


def fine_copper_chain(df: DataFrame, tph: Mapping[str, Model], tails: Mapping[str, Model], conc: str, feed: str, weights: Sequence[float],
                      ratio_col: str | None = None, total_col: str = "tph_total", prefix: str = "chain") -> DataFrame:
    """OPT4: fine copper of a row by chained models.

    Throughputs are predicted from the row as it is; ratio and total follow; the
    tails' models see the row with them; recoveries (FEA6) and fine copper
    (FEA7) come from the predicted values.  Adds ``<prefix>_cuf``."""
    names = list(tph)
    d = df.withColumns({n: m(df) for n, m in tph.items()})
    if ratio_col:
        d = d.withColumn(ratio_col, safe_div(names[0], names[1]))
    d = d.withColumn(total_col, row_sum(names))
    d = d.withColumns({n: m(d) for n, m in tails.items()})
    d = FE.with_flotation_targets(d, conc, feed, list(tails), weights, prefix)
    return d.withColumn(f"{prefix}_cuf", FE.fine_copper(names, f"{prefix}_recup_wt", feed))
