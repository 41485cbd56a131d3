"""Random search: shared fits score as fits of their own; every draw and fold is there; the winner is the best."""
import pytest
from pyspark.sql import functions as F

from sensorloom.operators import ml as M
from sensorloom.operators import optimize as O


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(240).selectExpr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, cast(id as int)) AS ts", "cast(id * 37 % 50 as double) AS a",
                                       "CASE WHEN id % 9 > 0 THEN cast(id * 11 % 17 as double) END AS b", "cast(id * 37 % 50 as double) * 2 + id * 11 % 17 AS y").cache()


def test_draws_are_distinct_and_all_of_a_small_space(spark):
    space = {"maxIter": [1, 2, 3], "maxDepth": [2, 3], "stepSize": [0.1]}
    got = M.sample_params(space, 300, seed=3)
    assert len(got) == 6 == len({tuple(sorted(p.items())) for p in got})
    assert len(M.sample_params(space, 4)) == 4 and M.sample_params(space, 4) == M.sample_params(space, 4)


def test_lengths_of_one_fit_score_like_their_own(spark, rows):
    space = {"maxIter": [2, 5], "maxDepth": [2], "minInstancesPerNode": [1, 20], "subsamplingRate": [0.7], "stepSize": [0.1], "seed": [11]}
    best, results = M.tune(rows, "ts", ["a", "b"], "y", "gbt", space, draws=300, n_splits=3)
    res = results.collect()
    assert {(r.draw, r.fold) for r in res} == {(d, k) for d in range(4) for k in range(3)}
    folded = M.time_folds(rows, "ts", 3)
    for r in [x for x in res if x.fold == 1]:
        p = eval(r.params)
        m = M.fit(folded.where("fold < 1"), ["a", "b"], "y", M.load_regressor("gbt", **p))
        own = M.regression_metrics(M.predict(m, folded.where("fold = 1")), "y", "prediction").first().rmse
        assert r.rmse == pytest.approx(own, rel=1e-9)
    mean = {d: sum(r.rmse for r in res if r.draw == d) / 3 for d in range(4)}
    won = eval(next(r.params for r in res if r.draw == min(mean, key=mean.get)))
    assert best.stages[-1].getNumTrees == won["maxIter"]
    assert best.stages[-1].getOrDefault("minInstancesPerNode") == won["minInstancesPerNode"]


def test_sensitivity_covers_every_variable_and_both_ends(spark):
    td = spark.createDataFrame([("a", 0.0, 10.0, None, None), ("b", None, 4.0, -1.0, 1.0), ("c", 3.0, 3.0, None, None), ("d", None, None, None, 2.0)],
                               "tag string, op_min double, op_max double, range_min double, range_max double")
    limits = O.control_limits(td)
    assert sorted(map(tuple, limits.collect())) == [("a", 0.0, 10.0), ("b", -1.0, 1.0)]
    states = spark.createDataFrame([("t1", 1.0, 2.0), ("t2", None, 3.0)], "ts string, a double, b double")
    got = O.model_sensitivity(states, limits, O.expression_objective(F.col("a") * 10 + F.col("b")), 5)
    by = {(r.variable, r.value, r.ts): r.target for r in got.collect()}
    assert len(by) == 2 * 2 * 5 and by["a", 10.0, "t2"] == 103.0 and by["b", -1.0, "t1"] == 9.0 and by["b", 1.0, "t2"] is None
    with pytest.raises(ValueError):
        O.model_sensitivity(states, limits.limit(0), O.expression_objective(F.lit(0.0)))
