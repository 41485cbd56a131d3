"""Data expectations and anomaly checks (QC12–QC18, WIN11, WIN12).

Each suite is one (or a few) aggregate jobs returning result rows
``(check, column, success, observed)`` instead of a validation service.
Anomaly detectors return per-row flags over the long layout, computed with
halo-bucket windows (no whole-series window in one task).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.operators import windows as W
from sensorloom.operators.quantiles import column_quantiles, exact_quantiles
from sensorloom.session import written

RESULT = "check string, column string, success boolean, observed string"


def _row(check: str, column: str | None, success, observed):
    return F.struct(F.lit(check).alias("check"), F.lit(column).cast("string").alias("column"),
                    success.alias("success"), observed.cast("string").alias("observed"))


def expectation_suite(df: DataFrame, columns: Sequence[str], min_rows: int, max_rows: int,
                      ranges: Mapping[str, tuple], ts_col: str | None = None,
                      ts_format: str | None = None, pair: tuple[str, str] | None = None,
                      schema: Mapping[str, str] | None = None) -> DataFrame:
    """QC12: columns exist, row count between, not NULL, schema types, time
    format, values within dictionary ranges, two sensors equal — one aggregate."""
    spark = df.sparkSession
    static = [(f"column_exists", c, c in df.columns, c in df.columns) for c in columns]
    if schema:
        types = dict(df.dtypes)
        static += [("column_type", c, types.get(c) == t, types.get(c)) for c, t in schema.items()]
    aggs = [F.count(F.lit(1)).alias("_n")]
    present = [c for c in columns if c in df.columns]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null|{c}") for c in present]
    for c, (lo, hi) in ranges.items():
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (F.col(c) < lo)
        if hi is not None:
            bad = bad | (F.col(c) > hi)
        aggs.append(F.count_if(bad).alias(f"range|{c}"))
    if ts_col and ts_format:
        aggs.append(F.count_if(F.col(ts_col).isNotNull() & F.try_to_timestamp(F.col(ts_col), F.lit(ts_format)).isNull())
                    .alias("fmt"))
    if pair:
        aggs.append(F.count_if(~F.col(pair[0]).eqNullSafe(F.col(pair[1]))).alias("pair"))
    r = df.agg(*aggs)
    rows = [_row("row_count_between", None, (F.col("_n") >= min_rows) & (F.col("_n") <= max_rows), F.col("_n"))]
    rows += [_row("not_null", c, F.col(f"null|{c}") == 0, F.col(f"null|{c}")) for c in present]
    rows += [_row("between_tag_range", c, F.col(f"range|{c}") == 0, F.col(f"range|{c}")) for c in ranges]
    if ts_col and ts_format:
        rows.append(_row("time_format", ts_col, F.col("fmt") == 0, F.col("fmt")))
    if pair:
        rows.append(_row("pair_equal", f"{pair[0]}={pair[1]}", F.col("pair") == 0, F.col("pair")))
    dyn = r.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    st = spark.createDataFrame([(a, b, bool(c), str(d).lower() if isinstance(d, bool) else str(d))
                                for a, b, c, d in static], RESULT)
    return st.unionByName(dyn)


def flatline(long_pos: DataFrame, keys: Sequence[str], window: int,
             bucket_rows: int = W.DEFAULT_BUCKET_ROWS) -> DataFrame:
    """QC13/WIN4: rows ending a full window of ``window`` equal values."""
    return W.positional(long_pos, keys, "pos",
                        lambda w: {"flatline": F.coalesce(W.flatline_expr("value", window, w), F.lit(False))},
                        back=window - 1, bucket_rows=bucket_rows)


def quantile_anomaly(long: DataFrame, keys: Sequence[str], low: float, high: float) -> DataFrame:
    """QC14: values outside the key's own ``[q_low, q_high]`` (exact quantiles)."""
    q = exact_quantiles(long, keys, "value", [low, high]).withColumnsRenamed({"q0": "_lo", "q1": "_hi"})
    j = long.join(q, list(keys), "left")
    return j.withColumn("anomaly", F.coalesce((F.col("value") < F.col("_lo")) | (F.col("value") > F.col("_hi")),
                                              F.lit(False))).drop("_lo", "_hi")


def _iqr_flag(d: DataFrame, keys: Sequence[str], col: str, factor: float, side: str) -> DataFrame:
    q = exact_quantiles(d, keys, col, [0.25, 0.75]).withColumnsRenamed({"q0": "_q1", "q1": "_q3"})
    j = d.join(q, list(keys), "left")
    iqr = F.col("_q3") - F.col("_q1")
    hi = F.col(col) > F.col("_q3") + F.lit(factor) * iqr
    lo = F.col(col) < F.col("_q1") - F.lit(factor) * iqr
    flag = {"positive": hi, "negative": lo}.get(side, hi | lo)
    return j.withColumn("anomaly", F.coalesce(flag, F.lit(False))).drop("_q1", "_q3")


def level_shift(long_pos: DataFrame, keys: Sequence[str], window: int, factor: float = 6.0,
                side: str = "both", bucket_rows: int = W.DEFAULT_BUCKET_ROWS) -> DataFrame:
    """WIN11/QC15: ``median(next w) − median(previous w)`` beyond ``factor × IQR``
    of that difference series (signed by ``side``)."""
    d = W.rolling_medians(long_pos, keys, "pos", "value", {"_next": (0, window - 1), "_past": (-window, -1)}, bucket_rows)
    d = d.withColumn("_diff", F.col("_next") - F.col("_past")).drop("_next", "_past")
    return _iqr_flag(d, keys, "_diff", factor, side).withColumnRenamed("_diff", "shift")


def persist_shift(long_pos: DataFrame, keys: Sequence[str], window: int, factor: float = 6.0,
                  side: str = "both", bucket_rows: int = W.DEFAULT_BUCKET_ROWS) -> DataFrame:
    """WIN12/QC15: ``x − median(previous w)`` beyond ``factor × IQR`` of that series."""
    d = W.rolling_medians(long_pos, keys, "pos", "value", {"_past": (-window, -1)}, bucket_rows)
    d = d.withColumn("_diff", F.col("value") - F.col("_past")).drop("_past")
    return _iqr_flag(d, keys, "_diff", factor, side).withColumnRenamed("_diff", "shift")


def kmeans_anomaly(df: DataFrame, cols: Sequence[str], k: int = 2, seed: int = 1) -> DataFrame:
    """QC16: k-means on the sensor vector; rows of the smallest cluster are anomalous.

    Rows with a NULL sensor cannot be clustered: they stay, with NULL cluster and anomaly."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in cols])
    vec = VectorAssembler(inputCols=list(cols), outputCol="_v").transform(df.where(whole))
    if vec.isEmpty():
        return df.select("*", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("boolean").alias("anomaly"))
    lab = KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="_c").fit(vec).transform(vec)
    sizes = lab.groupBy("_c").count()
    smallest = sizes.orderBy("count", "_c").limit(1).select(F.col("_c").alias("_s"))
    out = lab.join(smallest, F.col("_c") == F.col("_s"), "left") \
        .withColumn("anomaly", F.col("_s").isNotNull()).drop("_v", "_s").withColumnRenamed("_c", "cluster")
    rest = df.where(~F.coalesce(whole, F.lit(False)))
    return out.unionByName(rest.withColumns({"cluster": F.lit(None).cast("int"), "anomaly": F.lit(None).cast("boolean")}))


def _average_path(n):
    """Mean depth of a failed search among ``n`` points."""
    n = np.maximum(n, 2)
    return np.where(n > 2, 2.0 * (np.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n, 1.0)


def _grow(x: np.ndarray, depth: int, rng) -> list[tuple]:
    """A random split tree as rows ``(column, split, left, right, path)``; leaves have column −1 and their path length."""
    nodes: list[tuple] = []

    def add(part: np.ndarray, level: int) -> int:
        at = len(nodes)
        nodes.append(())
        low, high = (part.min(axis=0), part.max(axis=0)) if len(part) else (np.zeros(0), np.zeros(0))
        open_ = np.nonzero(low < high)[0]
        if level >= depth or not len(open_):
            nodes[at] = (-1, 0.0, 0, 0, level + (float(_average_path(len(part))) if len(part) > 1 else 0.0))
            return at
        j = int(rng.choice(open_))
        split = float(rng.uniform(low[j], high[j]))
        side = part[:, j] < split
        nodes[at] = (j, split, add(part[side], level + 1), add(part[~side], level + 1), 0.0)
        return at

    add(x, 0)
    return nodes


def isolation_forest(df: DataFrame, cols: Sequence[str], n_trees: int = 50, sample: int = 256,
                     contamination: float = 0.05, seed: int = 7) -> DataFrame:
    """QC17: isolation-forest score ``2^(−E[h]/c(ψ))`` per row, anomalous above the
    ``1 − contamination`` quantile of the scores.

    Each tree draws about ``sample`` rows of the whole table: a vector that n rows
    have is drawn ``n * sample / rows`` times, rounded up or down by a seeded hash of
    the vector and the tree, so that hot vectors stay within the bound.  A tree is grown in a task of its own; the trees (bounded
    by ``n_trees`` and ``sample``) go to all tasks, which walk them level by level
    for a batch of rows at once.  Rows with a NULL sensor stay, with NULL score
    and anomaly.  Not number-for-number equal to other libraries' forests.
    """
    x = [F.col(c).cast("double") for c in cols]
    whole = reduce(lambda a, b: a & b, [c.isNotNull() & ~F.isnan(c) for c in x])
    # equal rows are one vector with a weight: a vector that a third of the rows have gets a third of each tree's draws
    vectors = written(df.where(whole).select(F.array(*x).alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("n")), "vectors")
    n = vectors.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    share = min(1.0, sample / max(n, 1))
    seat = F.pmod(F.xxhash64(F.col("x"), F.col("tree"), F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = vectors.select("x", "n", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree"))
    drawn = drawn.select("x", "tree", F.floor(F.col("n") * share + seat).cast("int").alias("times")).where("times > 0")
    drawn = drawn.select("tree", F.explode(F.array_repeat("x", F.col("times"))).alias("x"))
    depth = int(np.ceil(np.log2(max(sample, 2))))

    def plant(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        rows = np.array(sorted(map(tuple, pdf["x"])), dtype=float)  # the order rows arrive in must not matter
        nodes = _grow(rows, depth, np.random.default_rng([seed, tree]))
        out = pd.DataFrame(nodes, columns=["column", "split", "left", "right", "path"])
        return out.assign(tree=tree, node=range(len(out)))

    grown = drawn.groupBy("tree").applyInPandas(plant, "column int, split double, left int, right int, path double, tree int, node int")
    rows = grown.orderBy("tree", "node").toPandas()  # at most n_trees · 4 · sample nodes
    trees = [g[["column", "split", "left", "right", "path"]].to_numpy().T for _, g in rows.groupby("tree")]
    bc = df.sparkSession.sparkContext.broadcast(trees)
    usual = float(_average_path(min(sample, max(n, 2))))

    @F.pandas_udf("double")
    def score(vecs: pd.Series) -> pd.Series:
        out = np.full(len(vecs), np.nan)
        good = np.array([v is not None and all(y is not None and y == y for y in v) for v in vecs], dtype=bool)
        if good.any() and bc.value:
            data = np.stack([np.asarray(v, dtype=float) for v, g in zip(vecs, good) if g])
            total = np.zeros(len(data))
            for column, split, left, right, path in bc.value:
                at = np.zeros(len(data), dtype=int)
                for _ in range(depth):
                    j = column[at].astype(int)
                    below = data[np.arange(len(data)), np.maximum(j, 0)] < split[at]
                    at = np.where(j < 0, at, np.where(below, left[at], right[at]).astype(int))
                total += path[at]
            out[good] = np.power(2.0, -total / len(bc.value) / usual)
        return pd.Series(out)

    scored = written(df.withColumn("iso_score", F.nanvl(score(F.array(*x)), F.lit(None).cast("double"))), "scored")
    (threshold,) = column_quantiles(scored, ["iso_score"], [1.0 - contamination])["iso_score"]
    return scored.withColumn("anomaly", F.col("iso_score") > F.lit(threshold).cast("double"))


def histogram(long: DataFrame, keys: Sequence[str], bins: int = 30) -> DataFrame:
    """QC18: 30-bin histogram per key, empty bins with count 0 (no drawing); keys without values have none."""
    mm = long.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    j = long.where(F.col("value").isNotNull()).join(mm, list(keys))
    w = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    b = F.when(w == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / w), F.lit(bins - 1))).cast("int")
    counts = j.groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = mm.where(F.col("lo").isNotNull()).select(*keys, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = grid.join(counts, [*keys, "bin"], "left")
    return out.select(*keys, "bin", F.coalesce("count", F.lit(0).cast("long")).alias("count"), "lo", "hi")
