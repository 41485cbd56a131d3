"""Density clustering against a plain version; components; the choice of settings."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.operators import cluster as CL
from sensorloom.operators.density import density_labels
from sensorloom.operators.graph import components


def plain(rows, radius, least, smallest):
    """Labels by comparing all points."""
    x = np.array([[np.nan if v is None else v for v in r] for r in rows], float)
    good = np.nonzero(~np.isnan(x).any(axis=1))[0]
    far = ((x[good][:, None] - x[good][None]) ** 2).sum(2)
    near = far <= radius ** 2
    core = near.sum(1) >= least
    group = np.full(len(good), -1)
    for k in range(len(good)):
        if core[k] and group[k] < 0:
            group[k], todo = k, [k]
            while todo:
                for j in np.nonzero(near[todo.pop()] & core & (group < 0))[0]:
                    group[j] = k
                    todo.append(j)
    for k in range(len(good)):
        if not core[k]:
            reach = [(far[k, j], tuple(x[good[j]]), group[j]) for j in np.nonzero(near[k] & core)[0]]
            group[k] = min(reach)[2] if reach else -1
    sizes = {g: (group == g).sum() for g in set(group) - {-1}}
    order = sorted((g for g in sizes if sizes[g] >= smallest), key=lambda g: (-sizes[g], min(tuple(x[good[j]]) for j in np.nonzero(group == g)[0])))
    out = [0] * len(rows)
    for i, g in zip(good, group):
        out[i] = order.index(g) + 1 if g in order else 0
    return out


def blobs(rng, n, d):
    middles = rng.uniform(0, 10, (6, d))
    return [tuple(map(float, np.round(middles[k % 6] + rng.normal(size=d) * 0.35, 3))) for k in range(n)] + [tuple(map(float, rng.uniform(0, 10, d))) for _ in range(n // 5)]


@pytest.mark.parametrize("d, n, radius, least, smallest", [(2, 1650, 0.25, 8, 20), (3, 500, 0.6, 6, 1), (1, 300, 0.02, 5, 10)])
def test_labels_match_a_plain_version(spark, d, n, radius, least, smallest):
    rows = blobs(np.random.default_rng(d), n, d)
    rows += [rows[0]] * 40 + [tuple([None] * d), tuple([float("nan")] * d)]  # one hot place, no place
    cols = [f"v{i}" for i in range(d)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "id int, " + ", ".join(f"{c} double" for c in cols))
    got = [r.cluster for r in density_labels(df, cols, radius, least, smallest).orderBy("id").collect()]
    want = plain(rows, radius, least, smallest)
    assert got == want and 0 in want and max(want) >= 3


def test_no_rows_and_no_cores(spark):
    none = spark.createDataFrame([], "a double, b double")
    assert density_labels(none, ["a", "b"], 1.0, 3).count() == 0
    few = spark.createDataFrame([(0.0, 0.0), (5.0, 5.0)], "a double, b double")
    assert {r.cluster for r in density_labels(few, ["a", "b"], 1.0, 3).collect()} == {0}


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 90), (90, 95), (7, 7), (200 + 0, 201)] + [(300, 301 + k) for k in range(30)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[k] for k in range(41)} == {0} and {got[k] for k in (90, 95, 100)} == {90} and got[201] == 200 and got[330] == 300
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_least_noise_within_the_band_decides(spark):
    rows = [("a", 10.0, 0.30), ("b", 9.5, 0.05), ("c", 9.2, 0.05), ("d", 8.9, 0.0), ("e", 9.4, 0.2)]
    table = spark.createDataFrame(rows, "setting string, kl_div_total double, noise_cluster_size double")
    assert CL.choose(table).first().setting == "b"  # d is below 90 % of the best
    assert CL.choose(table, band=0.85).first().setting == "d"
    assert CL.choose(table, band=0.99).first().setting == "a"


def test_smallest_size_grows_until_the_number_of_clusters_fits(spark):
    rng = np.random.default_rng(0)
    small = [(float(x), float(y), float(x + y)) for x, y in rng.normal(size=(120, 2)) * 0.3 + np.repeat([[0, 0], [5, 0], [0, 5], [5, 5], [9, 9], [9, 0]], 20, axis=0)]
    big = [(float(x), float(y), float(x - y)) for x, y in rng.normal(size=(160, 2)) * 0.3 + np.repeat([[-6, -6], [-6, 6]], 80, axis=0)]
    df = spark.createDataFrame(small + big, "a double, b double, m double")
    scores, chosen, labels = CL.find_density_model(df, ["a", "b"], ["m"], 1.0, init_share=0.05, trials=2, min_clusters=2, max_clusters=3)
    best = chosen.first()
    assert best["round"] > 1 and best["n_clusters"] == 3  # two clusters and the noise
    assert scores.where(F.col("round") < best["round"]).where(F.col("n_clusters").between(2, 3)).count() == 0
    mine = labels.where((F.col("round") == best["round"]) & (F.col("min_samples") == best["min_samples"]))
    assert mine.count() == 280 and mine.where("cluster = 0").count() / 280 == pytest.approx(best["noise_cluster_size"])
    _, none, _ = CL.find_density_model(df, ["a", "b"], ["m"], 1.0, init_share=0.05, trials=2, min_clusters=50, max_clusters=60, rounds=2)
    assert none is None


def test_grid_is_bounded(spark):
    wide = spark.createDataFrame([(1 + k % 2, float(k % 7) + 1e8 * (k == 400), float(k % 5)) for k in range(401)], "cluster int, x double, m double")
    got = CL.kl_metrics(wide, ["x"], ["m"], "cluster").first()
    assert got.kl_div_cluster_vars > 0
    # by hand: two normals on the whole grid, wide enough to be thinned
    rows = [(1, -3e4), (1, 3e4), (2, -2e4), (2, 6e4)]
    got = CL.kl_metrics(spark.createDataFrame([(c, x, float(c)) for c, x in rows], "cluster int, x double, m double"), ["x"], ["m"], "cluster").first()
    grid = np.arange(-3e4, 6e4 + 0.1, 0.1)
    fits = [(0.0, 3e4), (2e4, 4e4)]
    lp, lq = (-(grid - mu) ** 2 / (2 * sd * sd) - np.log(sd * np.sqrt(2 * np.pi)) for mu, sd in fits)
    want = (np.exp(lp) * (lp - lq)).sum() + (np.exp(lq) * (lq - lp)).sum()
    assert got.kl_div_cluster_vars == pytest.approx(want, rel=1e-3)
