"""Per-tag data-quality statistics and screens (AGG7, AGG10, AGG11, QC4–QC11).

Input is the long layout ``(tag, ts, value)`` (plus ``pos`` where runs are
needed), so every statistic is one ``groupBy("tag", …)`` for all tags at
once — the reference loops over columns in Python, one pass per column.
Tables that are one row per tag are plain joins: adaptive execution broadcasts by size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions.exprs import MICROS_PER_SECOND, cut, epoch_us
from sensorloom.operators.joins import exclude_intervals
from sensorloom.operators import windows as W
from sensorloom.operators.quantiles import running_counts
from sensorloom.session import written

# Thresholds of the quality table flags (strict comparisons).
QA_THRESHOLDS = {"mean": 90, "max_null_window": 3600, "kurtosis": 200,
                 "count_unique": 5, "pct_n_most_common": 60}


def monthly_null_pct(long: DataFrame, ts_col: str = "ts") -> DataFrame:
    """AGG7: ``100·nulls/rows`` per tag and ``yyyy-MM`` month (rounded to 2),
    then ``describe`` over the months: count, mean, std, min, 25/50/75 %, max."""
    m = long.groupBy("tag", F.date_format(ts_col, "yyyy-MM").alias("month")).agg(
        F.round(F.lit(100.0) * F.count_if(F.col("value").isNull()) / F.count(F.lit(1)), 2)
        .alias("null_pct"))
    p = F.col("null_pct")
    return m.groupBy("tag").agg(
        F.count(p).cast("double").alias("count"), F.avg(p).alias("mean"),
        F.stddev_samp(p).alias("std"), F.min(p).alias("min"),
        F.percentile(p, F.lit(0.25)).alias("p25"), F.percentile(p, F.lit(0.5)).alias("p50"),
        F.percentile(p, F.lit(0.75)).alias("p75"), F.max(p).alias("max"))


def concentration(long: DataFrame, top_n: int = 3, digits: int = 4) -> DataFrame:
    """AGG10: per tag excess kurtosis (biased), distinct count of values rounded
    half-even to ``digits``, and the share (%) of all rows held by the ``top_n``
    most frequent raw values (NULLs never form a mode but count in the base).

    Values are counted once.  The top-n is taken in parts of a tag's values, dealt by
    hash, and then among the parts' winners; distinct rounded values are rows of
    an aggregate, which are counted.  So no task sees all values of a tag.
    """
    spark = long.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    vc = written(long.groupBy("tag", "value").agg(F.count(F.lit(1)).alias("_n")), "value-counts")
    base = long.groupBy("tag").agg(F.kurtosis("value").alias("kurtosis"), F.count(F.lit(1)).alias("_rows"))
    there = vc.where(F.col("value").isNotNull())
    unique = there.groupBy("tag", F.bround("value", digits).alias("_v")).agg(F.lit(1).alias("_one")).groupBy("tag").agg(F.count(F.lit(1)).alias("count_unique"))
    order = [F.col("_n").desc(), F.col("value")]
    dealt = there.withColumn("_part", F.pmod(F.xxhash64("value"), F.lit(parts)))
    near = dealt.withColumn("_r", F.row_number().over(Window.partitionBy("tag", "_part").orderBy(*order))).where(F.col("_r") <= top_n)
    won = near.withColumn("_r", F.row_number().over(Window.partitionBy("tag").orderBy(*order))).where(F.col("_r") <= top_n)
    top = won.groupBy("tag").agg(F.sum("_n").alias("_top"))
    j = base.join(top, "tag", "left").join(unique, "tag", "left")
    return j.select("tag", "kurtosis",
                    (F.lit(100.0) * F.coalesce(F.col("_top"), F.lit(0)) / F.col("_rows"))
                    .alias("pct_n_most_common"),
                    F.coalesce("count_unique", F.lit(0).cast("long")).alias("count_unique"))


def ks_windows(spark, start, end, step_days: int = 28, base_days: int = 56,
               next_days: int = 14) -> DataFrame:
    """Window table for AGG11: starts every ``step_days`` from the first day;
    period 1 = ``[s, s + base − 1 day]``, period 2 = ``[s + base, s + base + next]``
    (both inclusive); only windows whose period 2 ends by ``end``."""
    rows = []
    s = start
    from datetime import timedelta
    while s + timedelta(days=base_days + next_days) <= end:
        rows.append((s, s + timedelta(days=base_days - 1), s + timedelta(days=base_days),
                     s + timedelta(days=base_days + next_days)))
        s = s + timedelta(days=step_days)
    return spark.createDataFrame(
        rows, "start1 timestamp_ntz, end1 timestamp_ntz, start2 timestamp_ntz, end2 timestamp_ntz")


def ks_stability(long: DataFrame, windows: DataFrame, ts_col: str = "ts",
                 unstable_d: float = 0.5) -> DataFrame:
    """AGG11: two-sample KS distance per (tag, window) between period 1 and 2.

    Rows are routed to windows by an equi join on a day bucket (each window
    covers a bounded number of days), values are pre-counted per
    (tag, window, value, sample), and ``D = max |F1 − F2|`` is read at the end
    of each tie group from running sums over sorted value ranges.
    Returns ``(tag, start_date, end_date, ks, n1, n2, is_unstable, p_value)``.
    """
    day = 86_400 * MICROS_PER_SECOND
    w = windows.select(
        "start1", "end1", "start2", "end2",
        F.explode(F.sequence(F.floor(epoch_us("start1") / day),
                             F.floor(epoch_us("end2") / day))).alias("_d"))
    d = long.where(F.col("value").isNotNull()).withColumn("_d", F.floor(epoch_us(ts_col) / day))
    j = d.join(w, "_d")
    s1 = (F.col(ts_col) >= F.col("start1")) & (F.col(ts_col) <= F.col("end1"))
    s2 = (F.col(ts_col) >= F.col("start2")) & (F.col(ts_col) <= F.col("end2"))
    j = j.select("tag", "start1", "end2", "value", s1.cast("int").alias("_a"),
                 s2.cast("int").alias("_b")).where((F.col("_a") + F.col("_b")) > 0)
    vc = j.groupBy("tag", "start1", "end2", "value").agg(F.sum("_a").alias("_a"),
                                                         F.sum("_b").alias("_b"))
    key = ["tag", "start1", "end2"]
    vc = running_counts(vc, key, "value", ["_a", "_b"])
    vc = vc.select(*key, "value", F.col("cum__a").alias("_ca"), F.col("cum__b").alias("_cb"),
                   F.col("all__a").alias("n1"), F.col("all__b").alias("n2"))
    diff = F.abs(F.col("_ca") / F.col("n1") - F.col("_cb") / F.col("n2"))
    ks = vc.where((F.col("n1") > 0) & (F.col("n2") > 0)).groupBy(*key).agg(
        F.max(diff).alias("ks"), F.first("n1").alias("n1"), F.first("n2").alias("n2"))
    return ks.select("tag", F.col("start1").alias("start_date"), F.col("end2").alias("end_date"),
                     "ks", "n1", "n2", (F.col("ks") >= unstable_d).cast("int").alias("is_unstable"), ks_pvalue().alias("p_value"))


def ks_pvalue(ks_col: str = "ks", n1: str = "n1", n2: str = "n2", terms: int = 100):
    """Asymptotic two-sided KS p-value (Kolmogorov series), as a Column."""
    en = F.sqrt(F.col(n1) * F.col(n2) / (F.col(n1) + F.col(n2)))
    lam = (en + F.lit(0.12) + F.lit(0.11) / en) * F.col(ks_col)
    term = lambda k: F.lit(2.0) * F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(F.lit(-2.0) * k * k * lam * lam)
    series = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0), lambda t, k: t + term(k))
    # the series does not converge for equal samples
    series = F.when(lam < 0.04, F.lit(1.0)).otherwise(series)
    return F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0))


def ks_summary(ks: DataFrame, windows: DataFrame) -> DataFrame:
    """Per tag: % of all rolling windows flagged unstable; a window without data is not unstable."""
    n = max(windows.count(), 1)
    return ks.groupBy("tag").agg((F.lit(100.0) * F.sum("is_unstable") / F.lit(float(n))).alias("pct_unstable"))


def null_run_table(long_pos: DataFrame, bucket_rows: int = W.DEFAULT_BUCKET_ROWS) -> DataFrame:
    """AGG8 as the quality table wants it: ``(tag, Max_Null_Window)``."""
    return W.max_null_run(long_pos, ["tag"], "pos", "value", bucket_rows) \
        .withColumnRenamed("max_null_run", "Max_Null_Window")


def create_qa_table(tags: DataFrame, stat_na: DataFrame, conc: DataFrame, null_runs: DataFrame,
                    td: DataFrame | None = None) -> DataFrame:
    """QC10 + JOI10/JOI11: tag list ⟕ null stats ⟕ concentration ⟕ NULL runs,
    five strict 0/1 flags (a NULL comparison gives 0), ``score`` = Σ flags;
    then dictionary ⟕ table when a dictionary is given."""
    t = QA_THRESHOLDS
    j = (tags.select("tag")
         .join(stat_na.select("tag", "mean", "std"), "tag", "left")
         .join(conc, "tag", "left")
         .join(null_runs, "tag", "left"))
    kurt = F.coalesce(F.col("kurtosis"), F.lit(0.0))

    def flag(pred):
        return F.coalesce(pred, F.lit(False)).cast("int")
    flags = {
        "too_many_na_per_month": flag(F.col("mean") > t["mean"]),
        "too_many_consecutives_na": flag(F.col("Max_Null_Window") > t["max_null_window"]),
        "kurtosis_thresh": flag(kurt > t["kurtosis"]),
        "few_unique_values": flag(F.col("count_unique") < t["count_unique"]),
        "mode_freq_thresh": flag(F.col("pct_n_most_common") > t["pct_n_most_common"]),
    }
    j = j.select("tag", "mean", "std", kurt.alias("kurtosis"), "pct_n_most_common",
                 "count_unique", "Max_Null_Window", *[v.alias(k) for k, v in flags.items()])
    j = j.withColumn("score", reduce(lambda a, b: a + b, [F.col(k) for k in flags]))
    if td is None:
        return j
    return td.join(j, "tag", "left")


def go_or_no_go(qa: DataFrame, td: DataFrame, feature_cols: Sequence[str], raise_on_no_go: bool = False) -> DataFrame:
    """QC11: for every ``*_feature`` flag, non-derived selected tags grouped by
    score; ``go`` is false when any selected tag has score ≥ 2 (decision D7).
    With ``raise_on_no_go`` a flag that is no go raises and names its tags."""
    scored = td.join(qa.select("tag", "score"), "tag", "left")
    long = scored.select("tag", "score", "derived", F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("boolean").alias("on"))
        for f in feature_cols])).alias("_f"))
    sel = long.where(F.col("_f.on") & ~F.coalesce(F.col("derived"), F.lit(False)))
    g = sel.groupBy(F.col("_f.feature").alias("feature"), "score").agg(
        F.count(F.lit(1)).alias("n_tags"), F.sort_array(F.collect_list("tag")).alias("tags"))
    go = g.groupBy("feature").agg(
        (~F.coalesce(F.max(F.col("score") >= 2), F.lit(False))).alias("go"))
    out = g.join(go, "feature")
    if raise_on_no_go:
        bad = out.where(~F.col("go") & (F.col("score") >= 2)).orderBy("feature", "score").limit(20).collect()
        if bad:
            raise ValueError("no go: " + "; ".join(f"{r.feature} score {r.score}: {', '.join(r.tags[:20])}" for r in bad))
    return out


def screen(stat_na: DataFrame, null_runs: DataFrame, ks_sum: DataFrame | None, conc: DataFrame,
           thresholds: Mapping[str, float]) -> DataFrame:
    """QC4–QC9: ``(tag, reason)`` for every tag removed by a screen.

    QC4 mean monthly NULL % ≥ t; QC5 longest NULL run ≥ t; QC6 % unstable KS
    windows ≥ t; QC7 kurtosis ≥ t, distinct values < t, top-3 share ≥ t.
    """
    t = thresholds
    parts = [
        stat_na.where(F.col("mean") >= t["null_pct"]).select("tag", F.lit("_count_monthly_na").alias("reason")),
        null_runs.where(F.col("Max_Null_Window") >= t["max_null_window"]).select(
            "tag", F.lit("_max_window_na").alias("reason")),
        conc.where(F.col("kurtosis") >= t["kurtosis"]).select("tag", F.lit("_concentrated_data_kurtosis").alias("reason")),
        conc.where(F.col("count_unique") < t["count_unique"]).select("tag", F.lit("_concentrated_data_count_unique").alias("reason")),
        conc.where(F.col("pct_n_most_common") >= t["pct_n_most_common"]).select(
            "tag", F.lit("_concentrated_data_mode_freq").alias("reason")),
    ]
    if ks_sum is not None:
        parts.append(ks_sum.where(F.col("pct_unstable") >= t["ks_unstable"]).select(
            "tag", F.lit("_ks_stability").alias("reason")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def prepared(long: DataFrame, ignore: DataFrame | None = None, ranges: Mapping[str, Sequence] | None = None, ts_col: str = "ts") -> DataFrame:
    """QC8's first steps on ``(tag, ts, value)``: rows in ignored date ranges go (``start_ts, end_ts``, both in), values outside a tag's
    range become NULL, and ``pos`` numbers each tag's remaining rows in time."""
    out = long if ignore is None else exclude_intervals(long, ignore, ts_col)
    for tag, (lo, hi) in (ranges or {}).items():
        out = out.withColumn("value", F.when(F.col("tag") == tag, cut("value", lo, hi)).otherwise(F.col("value")))
    return W.dense_index(out.drop("pos"), ["tag"], ts_col)


def removed_series(long: DataFrame, removed: DataFrame, ts_col: str = "ts") -> DataFrame:
    """QC18: the series of the removed tags with the first of their reasons in alphabet, the rows behind the plots."""
    reason = removed.groupBy("tag").agg(F.min("reason").alias("reason"))
    return long.join(reason, "tag").select("tag", ts_col, "value", "reason")


def drop_screened(long: DataFrame, removed: DataFrame) -> DataFrame:
    """QC9: drop the removed tags' rows (left anti join on ``tag``)."""
    return long.join(removed.select("tag").distinct(), "tag", "left_anti")
