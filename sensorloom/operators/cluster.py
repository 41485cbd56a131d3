"""Operating-regime clustering (CLU1–CLU6, AGG15).

HDBSCAN is a single-machine solver; the sweep is re-aimed at density labels
with noise (:mod:`sensorloom.operators.density`) and at MLlib ``KMeans`` /
``BisectingKMeans`` / ``GaussianMixture`` (labels differ from HDBSCAN).  The
selection score (symmetric KL between per-cluster normal fits) is computed
exactly as Spark aggregates: normal fits per (cluster, variable), a bounded
0.1-step grid per variable and cluster, and a join over cluster **pairs** (a
handful of clusters, never pairs of rows).
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from sensorloom.operators.density import labels_by_setting
from sensorloom.operators.quantiles import column_quantiles, exact_quantiles
from sensorloom.operators.reshape import to_long
from sensorloom.session import written


def scale(df: DataFrame, cols: Sequence[str], method: str = "standard") -> DataFrame:
    """CLU1: z-score (sample std, ddof 1) or robust ``(x − median) / IQR``.

    All columns' statistics come from one aggregate; exact percentiles."""
    if method == "standard":
        aggs = [F.avg(c).alias(f"c|{c}") for c in cols] + [F.stddev_samp(c).alias(f"s|{c}") for c in cols]
    elif method == "robust":
        got = column_quantiles(df, cols, [0.25, 0.5, 0.75])
        st = {f"c|{c}": m for c, (_, m, _) in got.items()}
        st |= {f"s|{c}": None if a is None else b - a for c, (a, _, b) in got.items()}
    else:
        raise ValueError("method must be standard or robust")
    if method == "standard":
        st = df.agg(*aggs).first().asDict()
    others = [c for c in df.columns if c not in cols]
    return df.select(*others, *[((F.col(c) - F.lit(st[f"c|{c}"])) / F.lit(st[f"s|{c}"])).alias(c)
                                if st[f"s|{c}"] else F.col(c) for c in cols])


def cluster_summary(df: DataFrame, label_col: str, metric_vars: Sequence[str]) -> DataFrame:
    """AGG15: cluster sizes (share of rows), per-cluster means, and the
    population std of cluster means per metric variable (one row)."""
    total = F.sum("_n").over(Window.partitionBy())  # one row per cluster
    per = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_n"),
                                    *[F.avg(v).alias(f"mean_{v}") for v in metric_vars])
    return per.select(label_col, (F.col("_n") / total).alias("size"),
                      *[f"mean_{v}" for v in metric_vars])


#: most grid points of a variable and cluster
GRID_POINTS = 1 << 14


def kl_metrics(df: DataFrame, cluster_vars: Sequence[str], metric_vars: Sequence[str],
               label_col: str, noise_label: int = 0, step: float = 0.1, by: Sequence[str] = ()) -> DataFrame:
    """CLU3: the score table of a labelling, one row; with ``by`` one row per labelling in long rows.

    Per variable and cluster a normal fit (mean, population std); densities on
    the grid ``min, min+0.1, … < max+0.1``; symmetric KL
    ``Σ p·ln(p/q) [p≠0] + Σ q·ln(q/p) [q≠0]`` for every pair of non-noise
    clusters.  ``kl_div_cluster_vars`` = mean over cluster variables of the max
    over pairs; ``kl_div_cluster_metrics`` = sum over metric variables and
    pairs; ``kl_div_total`` = their average.  Also sizes, noise share and
    ``metric_var_std`` (Σ over metric variables of the population std of the
    cluster means).

    A sum over p needs grid points only where p is not 0 as a double, within 39 standard
    deviations.  Where that is more than ``GRID_POINTS`` points, every s-th point counts s
    times: the density is then so wide that the sum is the same to many digits.  So a variable
    has a bounded number of rows whatever its range.
    """
    by = list(by)
    allv = list(cluster_vars) + list(metric_vars)
    long = to_long(df, [*by, label_col], allv, "var", "x").withColumnRenamed(label_col, "lab")
    fit = long.groupBy(*by, "var", "lab").agg(F.avg("x").alias("mu"), F.stddev_pop("x").alias("sd"), F.min("x").alias("l"), F.max("x").alias("h"))
    rng = fit.groupBy(*by, "var").agg(F.min("l").alias("lo"), F.max("h").alias("hi"))
    # a cluster without spread has no density and leaves its pairs out
    fit = fit.where((F.col("lab") != noise_label) & (F.col("sd") > 0)).select(*by, "var", "lab", "mu", "sd")
    steps = F.ceil(((F.col("hi") + F.lit(step)) - F.col("lo")) / F.lit(step)).cast("long")
    first = F.greatest(F.lit(0).cast("long"), F.floor((F.col("mu") - 39 * F.col("sd") - F.col("lo")) / F.lit(step)))
    last = F.least(steps - 1, F.ceil((F.col("mu") + 39 * F.col("sd") - F.col("lo")) / F.lit(step)))
    own = fit.join(rng, [*by, "var"]).withColumns({"first": first, "last": last})
    own = own.withColumn("stride", F.floor((F.col("last") - F.col("first")) / F.lit(GRID_POINTS)) + 1)
    own = own.withColumn("k", F.explode(F.sequence("first", "last", "stride")))
    x = F.col("lo") + F.col("k") * F.lit(step)

    def log_density(mu: str, sd: str) -> Column:
        return -F.try_divide((x - F.col(mu)) ** 2, F.lit(2.0) * F.col(sd) ** 2) - F.log(F.col(sd) * F.lit(math.sqrt(2 * math.pi)))
    other = fit.select(*by, "var", F.col("lab").alias("lab2"), F.col("mu").alias("mu2"), F.col("sd").alias("sd2"))
    pr = own.join(other, [*by, "var"]).where("lab <> lab2").withColumns({"lp": log_density("mu", "sd"), "lq": log_density("mu2", "sd2")})
    # from the logs, so that a far cluster whose density is 0 as a double does not divide by it
    term = F.exp("lp") * (F.col("lp") - F.col("lq")) * F.col("stride")
    kl = pr.groupBy(*by, "var", F.least("lab", "lab2").alias("la"), F.greatest("lab", "lab2").alias("lb")).agg(F.sum(term).alias("kl"))
    cv = kl.where(F.col("var").isin(list(cluster_vars))).groupBy(*by, "var").agg(F.max("kl").alias("m"))
    kl_vars = cv.groupBy(*by).agg((F.sum("m") / F.lit(float(len(cluster_vars)))).alias("kl_div_cluster_vars"))
    kl_met = kl.where(F.col("var").isin(list(metric_vars))).groupBy(*by).agg(F.sum("kl").alias("kl_div_cluster_metrics"))
    per = df.groupBy(*by, label_col).agg(F.count(F.lit(1)).alias("n"), *[F.avg(v).alias(f"_m_{v}") for v in metric_vars])
    total = F.sum("n").over(Window.partitionBy(*by))  # a row per cluster
    share = F.col("n") / F.col("t")
    out = per.withColumn("t", total).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_clusters"), F.min(share).alias("smallest_cluster"), F.max(share).alias("largest_cluster"),
        F.coalesce(F.max(F.when(F.col(label_col) == noise_label, share)), F.lit(0.0)).alias("noise_cluster_size"),
        sum((F.stddev_pop(f"_m_{v}") for v in metric_vars), F.lit(0.0)).alias("metric_var_std"))
    keys = by or ["_j"]
    tables = [t if by else t.withColumn("_j", F.lit(1)) for t in (out, kl_vars, kl_met)]
    out = tables[0].join(tables[1], keys, "left").join(tables[2], keys, "left")
    out = out.fillna(0.0, ["kl_div_cluster_vars", "kl_div_cluster_metrics"])
    out = out if by else out.drop("_j")
    return out.withColumn("kl_div_total", F.col("kl_div_cluster_metrics") * 0.5
                          + F.col("kl_div_cluster_vars") * 0.5)


def params_grid(spark, space: Mapping[str, Sequence]) -> DataFrame:
    """CLU5: cartesian product of parameter lists (small metadata table)."""
    keys = sorted(space)
    rows = [dict(zip(keys, v)) for v in itertools.product(*[space[k] for k in keys])]
    return spark.createDataFrame(rows)


def fit_labels(df: DataFrame, cols: Sequence[str], algo: str, k: int, seed: int = 1,
               label_col: str = "cluster") -> DataFrame:
    """Fit one MLlib clusterer and attach integer labels ``1..k`` (0 = noise, unused)."""
    vec = VectorAssembler(inputCols=list(cols), outputCol="_v").transform(df)
    est = {"kmeans": KMeans, "bisecting": BisectingKMeans, "gmm": GaussianMixture}[algo](
        k=k, seed=seed, featuresCol="_v", predictionCol="_p")
    vec = vec.persist()
    try:
        model = est.fit(vec)
    finally:
        vec.unpersist()
    return model.transform(vec).withColumn(label_col, (F.col("_p") + 1).cast("int")) \
        .drop("_v", "_p", *(["probability"] if algo == "gmm" else []))


def choose(table: DataFrame, band: float = 0.9) -> DataFrame:
    """TOP3: the one row of a score table whose total is above ``band`` of the best, with the least noise;
    of equally noisy ones the best total, then the first settings."""
    best = table.agg(F.max("kl_div_total").alias("_best"))  # one row
    close = table.join(F.broadcast(best), F.col("kl_div_total") > F.col("_best") * band).drop("_best")
    names = [c for c in table.columns if c not in ("noise_cluster_size", "kl_div_total")]
    order = F.struct("noise_cluster_size", (-F.col("kl_div_total")).alias("t"), *names)
    return close.groupBy().agg(F.min_by(F.struct(*table.columns), order).alias("r")).select("r.*")


def find_best_model(df: DataFrame, cluster_vars: Sequence[str], metric_vars: Sequence[str],
                    grid: Sequence[tuple[str, int]], min_clusters: int = 3, max_clusters: int = 6,
                    band: float = 0.9) -> tuple[tuple, DataFrame]:
    """CLU2 (re-aimed) + TOP3: score each (algorithm, k) of ``grid`` with CLU3,
    keep 3–6 clusters, take the best ``kl_div_total`` and, among those within
    ``band`` of it, the one with the least noise.  Returns (choice, table).

    The fits run a few at a time; their labels are one table of long rows, scored together."""
    df = written(df, "sweep")  # every fit reads the table, not what made it
    asked = [(a, k) for a, k in grid if min_clusters <= k <= max_clusters]

    def labels(setting: tuple[str, int]) -> DataFrame:
        algo, k = setting
        lab = fit_labels(df, cluster_vars, algo, k)
        return lab.select(F.lit(algo).alias("algo"), F.lit(k).alias("k"), "cluster", *cluster_vars, *metric_vars)
    with ThreadPool(4) as pool:
        fitted = pool.map(inheritable_thread_target(df.sparkSession)(labels), asked)
    long = written(reduce(DataFrame.unionByName, fitted), "labels")
    table = written(kl_metrics(long, cluster_vars, metric_vars, "cluster", by=["algo", "k"]), "scores")
    choice = choose(table, band).first()
    return (choice["algo"], choice["k"]), table


def find_density_model(df: DataFrame, cluster_vars: Sequence[str], metric_vars: Sequence[str], radius: float, init_share: float = 0.1,
                       trials: int = 3, min_clusters: int = 3, max_clusters: int = 6, band: float = 0.9, rounds: int = 5,
                       growth: float = 1.5) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """CLU2 with noise + TOP3: ``(scores of all settings tried, the chosen one or None, labels of the tried settings)``.

    Smallest clusters start at ``init_share`` of the rows.  In each round ``trials`` values of ``min_samples``
    up to a quarter of that size are tried; if none gives ``min_clusters`` to ``max_clusters`` groups (noise
    counts as one, as in CLU3's table), the size grows by ``growth``, for at most ``rounds`` rounds."""
    df = written(df, "density")
    number = df.count()
    size, scores, labels = float(int(init_share * number)), None, None
    for turn in range(rounds):
        quarter = int(size * 0.25)
        if quarter // trials == 0:
            raise ValueError("too few rows for this smallest cluster size and number of trials")
        samples = list(range(1, quarter, quarter // trials))[:trials + 1]
        lab = labels_by_setting(df, cluster_vars, radius, [(k, int(size)) for k in samples])
        lab = lab.withColumn("min_samples", F.array(*[F.lit(k) for k in samples])[F.col("setting")]).drop("setting")
        now = written(lab.withColumns({"round": F.lit(turn + 1), "min_cluster_size": F.lit(int(size))}), "labels")
        table = written(kl_metrics(now, cluster_vars, metric_vars, "cluster", by=["round", "min_cluster_size", "min_samples"]), "scores")
        scores = table if scores is None else scores.unionByName(table)
        labels = now if labels is None else labels.unionByName(now)
        fits = table.where(F.col("n_clusters").between(min_clusters, max_clusters))
        if not fits.isEmpty():
            return scores, choose(fits, band), labels
        size *= growth
    return scores, None, labels


def pca_scores(df: DataFrame, cols: Sequence[str], threshold: float = 0.8) -> tuple[int, DataFrame]:
    """CLU4: PCA keeping the fewest components whose cumulative explained
    variance reaches ``threshold``; scores appended as ``pc_1…pc_k``."""
    vec = VectorAssembler(inputCols=list(cols), outputCol="_v").transform(df)
    full = PCA(k=len(cols), inputCol="_v", outputCol="_pc").fit(vec)
    ev = full.explainedVariance.toArray()
    k, acc = 0, 0.0
    for v in ev:
        k += 1
        acc += v
        if acc >= threshold:
            break
    model = PCA(k=k, inputCol="_v", outputCol="_pc").fit(vec)
    out = model.transform(vec).withColumn("_a", vector_to_array("_pc"))
    return k, out.select(*df.columns, *[F.col("_a")[i].alias(f"pc_{i + 1}") for i in range(k)])


def box_stats(df: DataFrame, label_col: str, var: str) -> DataFrame:
    """CLU6: box-plot statistics of ``var`` by cluster (exact quartiles)."""
    x = F.col(var)
    ends = df.groupBy(label_col).agg(F.min(x).alias("min"), F.max(x).alias("max"), F.count(x).alias("n"))
    quartiles = exact_quantiles(df, [label_col], var, [0.25, 0.5, 0.75]).toDF(label_col, "q1", "median", "q3")
    return ends.join(quartiles, label_col, "left").select(label_col, "min", "q1", "median", "q3", "max", "n")
