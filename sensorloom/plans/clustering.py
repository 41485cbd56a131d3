"""Registered queries: scaling, cluster scores, box statistics, sweep (§2.12 CLU rows)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from sensorloom.operators import cluster as CL
from sensorloom.operators import joins as J
from sensorloom.operators.density import density_labels
from sensorloom.operators.transformers import FillMedian
from sensorloom.plans.common import SQL_HOURLY, finish, register, sql_r
from sensorloom.session import written
from sensorloom.sources import fixtures as FX
from sensorloom.sources.fixtures import TAGS

H = f"WITH h AS ({SQL_HOURLY})"
LAB = "((dayofmonth(ts) - 1) * 24 + hour(ts)) % 4"
CVARS, MVARS = ["click", "view"], ["purchase"]


@register("cluster_scaling", f"""{H},
s AS (SELECT {", ".join(f"avg({t}) AS m_{t}, stddev_samp({t}) AS s_{t}, median({t}) AS md_{t}, quantile_cont({t}, 0.75) - quantile_cont({t}, 0.25) AS iqr_{t}" for t in TAGS)} FROM h)
SELECT ts, {", ".join(f"{sql_r(f'({t} - m_{t}) / s_{t}')} AS z_{t}, {sql_r(f'({t} - md_{t}) / iqr_{t}')} AS r_{t}" for t in TAGS)}
FROM h, s
""")
def cluster_scaling(spark, sf_dir):
    """CLU1: standard (ddof 1) and robust (median / IQR) scaling."""
    h = FX.hourly_wide(spark, sf_dir).select("ts", *[F.col(t).alias(f"{k}_{t}") for t in TAGS for k in "zr"])
    z = CL.scale(h, [f"z_{t}" for t in TAGS], "standard")
    return finish(CL.scale(z, [f"r_{t}" for t in TAGS], "robust"))


def _kl_sql() -> str:
    allv = CVARS + MVARS
    unp = " UNION ALL ".join(f"SELECT lab, '{v}' AS var, {v} AS x FROM d" for v in allv)
    cv = ", ".join(f"'{v}'" for v in CVARS)
    mv = ", ".join(f"'{v}'" for v in MVARS)
    return f"""{H},
d AS (SELECT {LAB} AS lab, * FROM h WHERE {" AND ".join(f"{v} IS NOT NULL" for v in allv)}),
l AS ({unp}),
fit AS (SELECT var, lab, avg(x) AS mu, stddev_pop(x) AS sd FROM l GROUP BY 1, 2),
rng AS (SELECT var, min(x) AS lo, max(x) AS hi FROM l GROUP BY 1),
grid AS (SELECT var, k, lo + k * 0.1 AS x FROM (
           SELECT var, lo, unnest(generate_series(0, CAST(ceil(((hi + 0.1) - lo) / 0.1) AS BIGINT) - 1)) AS k
           FROM rng)),
pdf AS (SELECT g.var, g.k, f.lab,
               exp(-((g.x - f.mu) ** 2) / (2.0 * f.sd ** 2)) / (f.sd * {(2 * 3.141592653589793) ** 0.5!r}) AS p
        FROM grid g JOIN fit f USING (var)),
pr AS (SELECT a.var, a.lab AS la, b.lab AS lb,
              sum(CASE WHEN a.p <> 0 THEN a.p * ln(a.p / b.p) ELSE 0.0 END
                  + CASE WHEN b.p <> 0 THEN b.p * ln(b.p / a.p) ELSE 0.0 END) AS kl
       FROM pdf a JOIN pdf b ON a.var = b.var AND a.k = b.k AND a.lab < b.lab
       WHERE a.lab <> 0 AND b.lab <> 0 GROUP BY 1, 2, 3),
kv AS (SELECT coalesce(sum(m), 0.0) / {float(len(CVARS))!r} AS kl_div_cluster_vars
       FROM (SELECT var, max(kl) AS m FROM pr WHERE var IN ({cv}) GROUP BY var)),
km AS (SELECT coalesce(sum(kl), 0.0) AS kl_div_cluster_metrics FROM pr WHERE var IN ({mv})),
sz AS (SELECT count(*) AS n_clusters, min(n / t) AS smallest_cluster, max(n / t) AS largest_cluster,
              coalesce(max(CASE WHEN lab = 0 THEN n / t END), 0.0) AS noise_cluster_size
       FROM (SELECT lab, count(*) AS n, sum(count(*)) OVER () AS t FROM d GROUP BY lab)),
ms AS (SELECT {" + ".join(f"stddev_pop({v})" for v in MVARS)} AS metric_var_std
       FROM (SELECT lab, {", ".join(f"avg({v}) AS {v}" for v in MVARS)} FROM d GROUP BY lab))
SELECT n_clusters, {sql_r('smallest_cluster')} AS smallest_cluster, {sql_r('largest_cluster')} AS largest_cluster,
       {sql_r('noise_cluster_size')} AS noise_cluster_size, {sql_r('metric_var_std')} AS metric_var_std,
       {sql_r('kl_div_cluster_vars')} AS kl_div_cluster_vars,
       {sql_r('kl_div_cluster_metrics')} AS kl_div_cluster_metrics,
       {sql_r('kl_div_cluster_metrics * 0.5 + kl_div_cluster_vars * 0.5')} AS kl_div_total
FROM sz, ms, kv, km
"""


@register("cluster_kl_score", _kl_sql())
def cluster_kl_score(spark, sf_dir):
    """CLU3 + AGG15 + JOI6 + FLT13: KL score table of the fixed hourly labels
    (cluster = hour of month mod 4; label 0 is the noise group)."""
    h = FX.hourly_wide(spark, sf_dir)
    d = J.attach_labels(h, FX.cluster_labels(spark, sf_dir)).na.drop(subset=CVARS + MVARS)
    return finish(CL.kl_metrics(d, CVARS, MVARS, "cluster").withColumn(
        "n_clusters", F.col("n_clusters").cast("long")))


@register("cluster_box_stats", f"""{H},
d AS (SELECT {LAB} AS cluster, purchase FROM h)
SELECT cluster, {sql_r('min(purchase)')} AS min, {sql_r('quantile_cont(purchase, 0.25)')} AS q1,
       {sql_r('median(purchase)')} AS median, {sql_r('quantile_cont(purchase, 0.75)')} AS q3,
       {sql_r('max(purchase)')} AS max, count(purchase) AS n
FROM d GROUP BY cluster
""")
def cluster_box_stats(spark, sf_dir):
    """CLU6 box statistics by cluster for the rows of every cluster (JOI5)."""
    h = FX.hourly_wide(spark, sf_dir)
    lab = FX.cluster_labels(spark, sf_dir)
    labels = sorted(r.cluster for r in lab.select("cluster").distinct().collect())
    parts = [J.select_data_clusters(h, lab, k).withColumn("cluster", F.lit(k)) for k in labels]
    d = reduce(lambda a, b: a.unionByName(b), parts)
    return finish(CL.box_stats(d, "cluster", "purchase"))


@register("cluster_sweep")
def cluster_sweep(spark, sf_dir):
    """CLU5 parameter grid, CLU1 scaling, CLU4 PCA, CLU2 (re-aimed) sweep of
    KMeans, bisecting KMeans and Gaussian mixtures of 3 to 6 clusters scored by CLU3 and chosen with the TOP3 rule."""
    h = FX.hourly_wide(spark, sf_dir)
    h = written(FillMedian(columns=TAGS).fit(h).transform(h), "filled")  # every hour counts
    z = CL.scale(h, TAGS, "standard")
    k, pcs = CL.pca_scores(z, TAGS, 0.8)
    grid = [(r["algo"], int(r["k"])) for r in
            CL.params_grid(spark, {"algo": ["kmeans", "bisecting", "gmm"], "k": [3, 4, 5, 6]}).collect()]
    (algo, kbest), table = CL.find_best_model(pcs.join(h.select("ts", *[F.col(t).alias(f"raw_{t}") for t in MVARS]), "ts"),
                                              [f"pc_{i + 1}" for i in range(k)], [f"raw_{t}" for t in MVARS], grid)
    return finish(table.withColumn("chosen", (F.col("algo") == algo) & (F.col("k") == kbest))
                  .withColumn("n_components", F.lit(k)))


RADIUS, SAMPLES, SMALLEST = 3.5, 6, 15


@register("density_clusters", f"""WITH RECURSIVE h AS ({SQL_HOURLY}),
p AS (SELECT ts, click, view FROM h WHERE click IS NOT NULL AND view IS NOT NULL),
near AS MATERIALIZED (SELECT a.ts AS a, b.ts AS b, (a.click - b.click) ** 2 + (a.view - b.view) ** 2 AS far FROM p a JOIN p b
  ON (a.click - b.click) ** 2 + (a.view - b.view) ** 2 <= {RADIUS ** 2}),
core AS MATERIALIZED (SELECT a AS ts FROM near GROUP BY a HAVING count(*) >= {SAMPLES}),
links AS MATERIALIZED (SELECT n.a, n.b, n.far FROM near n JOIN core c ON n.b = c.ts),
reach AS (SELECT ts AS a, ts AS b FROM core UNION SELECT r.a, l.a FROM reach r JOIN links l ON r.b = l.b JOIN core c ON l.a = c.ts),
root AS (SELECT a AS ts, min(b) AS root FROM reach GROUP BY a),
lab AS (SELECT l.a AS ts, arg_min(r.root, (l.far, q.click, q.view)) AS root FROM links l JOIN root r ON l.b = r.ts JOIN p q ON q.ts = l.b GROUP BY l.a),
sizes AS (SELECT root, count(*) AS n, min((p.click, p.view)) AS least FROM lab JOIN p USING (ts) GROUP BY root HAVING count(*) >= {SMALLEST}),
numbers AS (SELECT root, row_number() OVER (ORDER BY n DESC, least) AS k FROM sizes)
SELECT h.ts, CAST(coalesce(k, 0) AS INTEGER) AS cluster FROM h LEFT JOIN lab USING (ts) LEFT JOIN numbers USING (root)
""")
def density_clusters(spark, sf_dir):
    """CLU2: density labels with noise of the hourly table by two sensors."""
    h = FX.hourly_wide(spark, sf_dir)
    return finish(density_labels(h, CVARS, RADIUS, SAMPLES, SMALLEST).select("ts", "cluster"))


@register("density_sweep")
def density_sweep(spark, sf_dir):
    """CLU2 with noise, its growth loop, CLU3 scores and the TOP3 choice, of every setting tried."""
    h = FX.hourly_wide(spark, sf_dir)
    h = FillMedian(columns=CVARS + MVARS).fit(h).transform(h)
    z = CL.scale(h, CVARS, "standard").select("ts", *CVARS, *MVARS)
    scores, chosen, _ = CL.find_density_model(z, CVARS, MVARS, radius=0.3, init_share=0.04, trials=3, min_clusters=2, max_clusters=6)
    keys = ["round", "min_cluster_size", "min_samples"]
    flag = scores.select(*keys, F.lit(False).alias("chosen")).limit(0) if chosen is None else chosen.select(*keys, F.lit(True).alias("chosen"))
    return finish(scores.join(flag, keys, "left").withColumn("chosen", F.coalesce("chosen", F.lit(False))))
