"""Value cleaning (CLN1–CLN14).

Row-local cleans are Column expressions.  Cleans that need statistics of
the column itself (own quantiles, medians) compute **all** columns' stats
in one aggregate — a single job whose result is one row of scalars — and
then apply them as literals in one ``select``.  In the long layout the
stats are one row per tag and are joined back on ``tag`` (broadcast only
after a size check).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.exprs import clip, cut, non_negative
from sensorloom.operators.quantiles import column_quantiles


def _quantiles(df: DataFrame, cols: Sequence[str], qs: dict[str, float], exact: bool = True,
               accuracy: int = 10_000) -> dict:
    """``{"name|col": quantile}``: linear-interpolated (pandas/numpy default), approximate on request."""
    if exact:
        got = column_quantiles(df, cols, list(qs.values()))
        return {f"{n}|{c}": got[c][i] for c in cols for i, n in enumerate(qs)}
    return _stats_row(df, {f"{n}|{c}": F.percentile_approx(F.col(c), F.lit(float(q)), accuracy)
                           for c in cols for n, q in qs.items()})


def _others(df: DataFrame, cols: Sequence[str]) -> list:
    return [F.col(c) for c in df.columns if c not in cols]


def cut_values_from_dict(df: DataFrame, ranges: Mapping[str, Sequence]) -> DataFrame:
    """CLN1: values outside each column's closed ``[lo, hi]`` become NULL."""
    return df.select(*_others(df, list(ranges)),
                     *[cut(c, lo, hi).alias(c) for c, (lo, hi) in ranges.items()])


def cut_values_from_list(df: DataFrame, cols: Sequence[str], interval: Sequence) -> DataFrame:
    """CLN2 / CLN11: one closed range for many columns."""
    lo, hi = interval
    return cut_values_from_dict(df, {c: (lo, hi) for c in cols})


def replace_outliers_by_value(df: DataFrame, limits: Mapping[str, Mapping]) -> DataFrame:
    """CLN3: clip each listed column to ``[low_value, high_value]`` (NULL stays NULL)."""
    return df.select(*_others(df, list(limits)),
                     *[clip(c, lim.get("low_value"), lim.get("high_value")).alias(c)
                       for c, lim in limits.items()])


def outlier_value_stats(df: DataFrame, limits: Mapping[str, Mapping], as_of, ts_col: str = "ts",
                        windows_days: Sequence[int] = (30, 60)) -> DataFrame:
    """AGG9: per tag, counts above/below the limits and non-NULL totals, overall
    and over trailing windows ending at ``as_of`` — one aggregate for all tags."""
    aggs = []
    for c, lim in limits.items():
        hi, lo = lim["high_value"], lim["low_value"]
        scopes = [("", F.lit(True))] + [
            (f"_{d}d", F.col(ts_col) >= F.lit(as_of) - F.expr(f"INTERVAL {int(d)} DAYS"))
            for d in windows_days]
        for suffix, in_scope in scopes:
            aggs += [F.count_if(in_scope & (F.col(c) > hi)).alias(f"{c}|count_high{suffix}"),
                     F.count_if(in_scope & (F.col(c) < lo)).alias(f"{c}|count_low{suffix}"),
                     F.count_if(in_scope & F.col(c).isNotNull()).alias(f"{c}|total{suffix}")]
    wide = df.agg(*aggs)
    # one row → one row per tag: stack the per-tag groups
    measures = [m.split("|", 1)[1] for m in wide.columns if m.startswith(f"{list(limits)[0]}|")]
    n = len(limits)
    args = ", ".join(f"'{c}', " + ", ".join(f"`{c}|{m}`" for m in measures) for c in limits)
    stacked = wide.selectExpr(f"stack({n}, {args}) AS (tag, {', '.join(measures)})")
    lim_rows = [(c, float(v["low_value"]), float(v["high_value"])) for c, v in limits.items()]
    lim_df = df.sparkSession.createDataFrame(lim_rows, "tag string, low_value double, high_value double")
    return stacked.join(lim_df, "tag")


def replace_outliers_by_nan(long_df: DataFrame, tag_dict: DataFrame, tag_col: str = "tag",
                            value_col: str = "value") -> DataFrame:
    """CLN4: long rows outside the tag's dictionary ``[range_min, range_max]`` → NULL.

    One-sided or missing ranges leave that side open.  The dictionary has one
    row per tag and is broadcast after a size check.
    """
    rng = tag_dict.select(F.col("tag").alias(tag_col), "range_min", "range_max")
    j = long_df.join(rng, tag_col, "left")
    v = F.col(value_col)
    bad = (F.col("range_min").isNotNull() & (v < F.col("range_min"))) | \
          (F.col("range_max").isNotNull() & (v > F.col("range_max")))
    return j.withColumn(value_col, F.when(bad, F.lit(None)).otherwise(v)) \
            .drop("range_min", "range_max")


def _stats_row(df: DataFrame, exprs: dict) -> dict:
    row = df.agg(*[e.alias(k) for k, e in exprs.items()]).first()
    return row.asDict() if row is not None else {}


def remove_outliers_quantile(df: DataFrame, cols: Sequence[str], bottom: float, top: float,
                             exact: bool = True) -> DataFrame:
    """CLN5: outside the column's own ``[q_bottom, q_top]`` → NULL (one stats job)."""
    st = _quantiles(df, cols, {"lo": bottom, "hi": top}, exact)
    return cut_values_from_dict(df, {c: (st[f"lo|{c}"], st[f"hi|{c}"]) for c in cols})


def esp_bounds(df: DataFrame, cols: Sequence[str], exact: bool = True) -> dict[str, tuple]:
    """The (p0, p99, cap) of CLN6 per column; the cap is None where there is nothing to work it out from.

    Two quantile jobs: the second needs the clip bounds of the first."""
    st = _quantiles(df, cols, {"p0": 0.0, "p99": 0.99}, exact)
    clipped = df.select(*[clip(c, st[f"p0|{c}"], st[f"p99|{c}"]).alias(c) for c in cols])
    st2 = _quantiles(clipped, cols, {"med": 0.5, "p95": 0.95}, exact)
    st3 = _stats_row(clipped, {f"sd|{c}": F.stddev_samp(F.when(F.col(c) < F.lit(st2[f"p95|{c}"]), F.col(c)))
                               for c in cols if st2[f"p95|{c}"] is not None})
    out = {}
    for c in cols:
        med, sd = st2[f"med|{c}"], st3.get(f"sd|{c}")
        out[c] = (st[f"p0|{c}"], st[f"p99|{c}"], None if med is None or sd is None else med + 10.0 * sd)
    return out


def clip_and_cap(df: DataFrame, bounds: Mapping[str, Sequence]) -> DataFrame:
    """Columns clipped to the first two of their bounds, and then held to the third where there is one."""
    out = []
    for c, (lo, hi, cap) in bounds.items():
        x = clip(c, lo, hi)
        out.append((x if cap is None else F.when(x > F.lit(cap), F.lit(cap)).otherwise(x)).alias(c))
    return df.select(*_others(df, list(bounds)), *out)


def remove_outliers_esp(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """CLN6: clip at own p0/p99, then cap at ``median + 10·std`` where median and
    p95 are of the clipped values and std (ddof 1) is over clipped values < p95."""
    return clip_and_cap(df, esp_bounds(df, cols, exact))


def data_imputation(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """CLN7 + CLN14: fill NULL with the column median, then negatives → 0."""
    st = {k.partition("|")[2]: v for k, v in _quantiles(df, cols, {"med": 0.5}, exact).items()}
    return df.select(*_others(df, cols),
                     *[non_negative(F.coalesce(F.col(c), F.lit(st[c]))).alias(c)
                       if st[c] is not None else non_negative(c).alias(c) for c in cols])


def round_for_counting(c: str, digits: int = 4):
    """CLN13: numpy rounds half to even — ``bround``, not ``round``."""
    return F.bround(F.col(c), digits)
