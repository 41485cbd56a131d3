"""Sliding medians, top values, attribution with interactions, weighted draws."""
import itertools
import math
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorloom.operators import expect as X
from sensorloom.operators import quality as Q
from sensorloom.operators import windows as W
from sensorloom.operators.attribution import permutation_attribution


def test_medians_of_1000_rows_match_pandas(spark):
    rng = np.random.default_rng(0)
    x = np.where(rng.random(5000) < 0.3, np.nan, rng.normal(size=5000).round(2))
    x[2000:3300] = np.nan
    rows = [("k", i, None if np.isnan(v) else float(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "tag string, pos long, value double")
    got = W.rolling_medians(df, ["tag"], "pos", "value", {"past": (-1000, -1), "next": (0, 999), "mid": (-2, 2)}, 1500).orderBy("pos").toPandas()
    s = pd.Series(x)
    past = s.rolling(1000, min_periods=1).median().shift(1)
    ahead = s[::-1].rolling(1000, min_periods=1).median()[::-1]
    mid = s.rolling(5, min_periods=1, center=True).median()
    for name, want in (("past", past), ("next", ahead), ("mid", mid)):
        np.testing.assert_allclose(got[name].astype(float), want, atol=1e-12, err_msg=name)


def test_time_does_not_grow_with_the_frame():
    x = np.random.default_rng(1).normal(size=20_000)
    took = []
    for w in (16, 4096):
        t = time.perf_counter()
        W.sliding_medians(x, -w, -1)
        took.append(time.perf_counter() - t)
    assert took[1] < 12 * took[0]


def test_null_runs_of_a_whole_default_bucket(spark):
    df = spark.range(W.DEFAULT_BUCKET_ROWS).selectExpr("'k' AS tag", "id AS pos", "cast(null AS double) AS value")
    t = time.perf_counter()
    r = W.null_runs(df, ["tag"], "pos").agg(F.min("run_len"), F.max("run_len"), F.bool_or("run_closed")).first()
    assert tuple(r) == (W.DEFAULT_BUCKET_ROWS, W.DEFAULT_BUCKET_ROWS, False) and time.perf_counter() - t < 30


def test_row_numbers_do_not_move(spark):
    df = spark.range(3000).selectExpr("id % 3 AS k", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, cast(id % 2 as int)) AS ts", "id AS v")
    one = W.dense_index(df.repartition(3), ["k"], "ts")
    two = W.dense_index(df.repartition(11, "v"), ["k"], "ts")
    assert one.exceptAll(two).count() == 0
    assert one.groupBy("k").agg(F.countDistinct("pos").alias("n"), F.max("pos").alias("m")).collect() == [(k, 1000, 999) for k in (0, 2, 1)] or \
        {tuple(r) for r in one.groupBy("k").agg(F.countDistinct("pos"), F.max("pos")).collect()} == {(k, 1000, 999) for k in range(3)}
    late = one.where("pos >= 500").agg(F.min("ts")).first()[0]
    assert late == one.agg(F.max("ts")).first()[0]


def test_top_values_of_many(spark):
    df = spark.range(60_000).selectExpr("'a' AS tag", "cast(CASE WHEN id < 900 THEN id % 3 ELSE id END AS double) / 100000 AS value")
    df = df.unionByName(spark.range(10).selectExpr("'none' AS tag", "cast(null AS double) AS value"))
    got = {r.tag: r for r in Q.concentration(df, digits=4).collect()}
    assert got["a"].pct_n_most_common == pytest.approx(100 * 900 / 60_000)
    assert got["a"].count_unique == len(set(np.round([k % 3 / 1e5 if k < 900 else k / 1e5 for k in range(60_000)], 4)))
    assert got["none"].count_unique == 0 and got["none"].pct_n_most_common == 0


def shapley(f, x, b):
    """Exact values of a function of few features against one point."""
    n, out = len(x), []
    for i in range(n):
        others = [j for j in range(n) if j != i]
        total = 0.0
        for size in range(n):
            for s in itertools.combinations(others, size):
                p = [x[j] if j in s else b[j] for j in range(n)]
                q = [x[j] if j in s or j == i else b[j] for j in range(n)]
                total += math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n) * (f(q) - f(p))
        out.append(total)
    return out


def test_interactions_against_exact_values(spark):
    names = list("abcde")
    f = lambda v: v[0] * v[1] + 2 * v[2] - v[3] * v[4] * v[0] + v[4]
    predict = lambda d: d.withColumn("prediction", F.col("a") * F.col("b") + 2 * F.col("c") - F.col("d") * F.col("e") * F.col("a") + F.col("e"))
    rows = [(0, 1.0, 2.0, -1.0, 0.5, 3.0), (1, -2.0, 0.0, 4.0, 1.0, 1.0)]
    points = [dict(zip(names, p)) for p in ([0.0] * 5, [1.0, 1.0, 0.5, 0.0, 2.0])]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{c} double" for c in names))
    got = permutation_attribution(df, ["id"], names, predict, points, permutations=400, seed=1).collect()
    for r in rows:
        want = np.mean([shapley(f, r[1:], [p[c] for c in names]) for p in points], axis=0)
        mine = {x.feature: x for x in got if x.id == r[0]}
        for c, w in zip(names, want):
            assert abs(mine[c].contribution - w) <= 4.5 * mine[c].std_error + 1e-9
        total = f(r[1:]) - np.mean([f([p[c] for c in names]) for p in points])
        assert sum(x.contribution for x in mine.values()) == pytest.approx(total)


@pytest.mark.parametrize("n", [1, 100])
def test_sums_add_up_for_any_number_of_features(spark, n):
    names = [f"f{k}" for k in range(n)]
    df = spark.range(5).select(F.col("id").cast("int").alias("id"), *[(F.col("id") * (k % 7) + k).cast("double").alias(f) for k, f in enumerate(names)])
    predict = lambda d: d.withColumn("prediction", sum((F.col(f) * (k % 5) for k, f in enumerate(names)), F.lit(1.0)) + F.col(names[0]) * F.col(names[-1]))
    out = permutation_attribution(df, ["id"], names, predict, {f: 0.5 for f in names}, permutations=3)
    zero = predict(spark.range(1).select(*[F.lit(0.5).alias(f) for f in names])).first().prediction
    sums = out.groupBy("id").agg(F.sum("contribution").alias("s"), F.count("*").alias("n")).join(predict(df).select("id", "prediction"), "id").collect()
    assert len(sums) == 5
    for r in sums:
        assert r.n == n and r.s == pytest.approx(r.prediction - zero)


def test_forest_draws_of_a_hot_vector_are_bounded(spark):
    rows = [(k, 1.0, 1.0) for k in range(4000)] + [(5000 + k, float(k % 13), float(k % 7)) for k in range(300)] + [(9000, 500.0, -300.0)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    out = X.isolation_forest(df, ["a", "b"], n_trees=20, sample=64, contamination=0.01)
    hot = out.where("a = 1 and b = 1").agg(F.max("iso_score")).first()[0]
    assert out.count() == len(rows)
    assert out.where("not (a = 1 and b = 1)").agg(F.min("iso_score")).first()[0] > hot
    assert out.where("id = 9000").first().iso_score > out.agg(F.percentile("iso_score", 0.95)).first()[0]
