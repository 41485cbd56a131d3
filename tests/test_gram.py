"""Wide correlations, linear models of units, the dependency closure."""
import numpy as np
import pandas as pd
import pytest

from sensorloom.operators import gram as G
from sensorloom.operators import tags as TG


def test_300_columns_with_gaps_match_pandas(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 300)).cumsum(axis=1) + 1e6 * (np.arange(300) % 3 == 0)
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 7], x[:, 8], x[5:, 9] = 4.0, np.nan, np.nan  # constant, empty, five numbers
    x[0, 10] = np.inf
    pdf = pd.DataFrame(x, columns=[f"c.{k}" for k in range(300)])
    got = G.correlation(spark.createDataFrame(pdf).repartition(6), list(pdf.columns)).toPandas()
    got = got.pivot(index="var_a", columns="var_b", values="corr").loc[pdf.columns, pdf.columns].to_numpy()
    want = pdf.replace(np.inf, np.nan).corr().to_numpy()
    assert (np.isnan(got) == np.isnan(want)).all()
    assert np.nanmax(np.abs(got - want)) < 1e-7


def test_units_match_least_squares(spark):
    rng = np.random.default_rng(1)
    rows, want = [], {}
    for unit, n in (("a", 60), ("b", 31), ("c", 4), (None, 24)):
        x = rng.normal(size=(n, 3)) * [1, 50, 0] + [0, 1e4, 3]  # the third does not vary
        y = x @ [2, -0.5, 7] + rng.normal(size=n)
        rows += [(unit, k, *map(float, x[k]), float(y[k])) for k in range(n)]
        size = n // 6
        blocks = [(None, n, slice(0, n))] + ([(f, n - (5 - f) * size, slice(n - (5 - f) * size, n - (4 - f) * size)) for f in range(5)] if size else [])
        for fold, upto, test in blocks:
            a = np.column_stack([np.ones(upto), x[:upto, :2]])
            b = np.linalg.lstsq(a, y[:upto], rcond=None)[0]
            e = np.column_stack([np.ones(len(y[test])), x[test, :2]]) @ b - y[test]
            want[unit, fold] = (*b, float(np.sqrt((e * e).mean())))
    rows += [("a", 100, None, 1.0, 1.0, 1.0)]  # left out of the sums
    rng.shuffle(rows := [tuple(r) for r in rows])
    df = spark.createDataFrame([r for r in rows if r[1] != 100], "unit string, o long, x1 double, x2 double, x3 double, y double")
    got = {(r.unit, r.fold): r for r in G.linear_per_unit(df, "unit", "o", ["x1", "x2", "x3"], "y").collect()}
    assert set(got) == set(want)
    for k, (b0, b1, b2, rmse) in want.items():
        r = got[k]
        assert [r.coefficients[1], r.coefficients[2], r.coefficients[3]] == pytest.approx([b1, b2, 0.0], rel=1e-5, abs=1e-6)
        assert r.coefficients[0] == pytest.approx(b0, rel=1e-4, abs=1e-2) and r.rmse == pytest.approx(rmse, rel=1e-4)


def test_missing_numbers_are_left_out(spark):
    df = spark.createDataFrame([("a", k, float(k), float(2 * k) if k % 3 else None) for k in range(12)], "unit string, o long, x double, y double")
    whole = G.linear_per_unit(df, "unit", "o", ["x"], "y").where("fold is null").first()
    assert whole.n_train == 8 and whole.coefficients == pytest.approx([0.0, 2.0], abs=1e-9)
    none = G.linear_per_unit(df.limit(0), "unit", "o", ["x"], "y")
    assert none.count() == 0


def test_closure_of_a_cycle_of_200_tags(spark):
    td = spark.createDataFrame([(f"t{k}", [f"t{(k + 1) % 200}"]) for k in range(200)] + [("x", ["t0", None]), ("y", []), ("z", None)],
                               "tag string, on_off_dependencies array<string>")
    got = TG.dependency_closure(td)
    assert got.count() == 200 * 200 + 200
    assert got.where("tag = 'x'").count() == 200 and got.where("tag = dependency").count() == 200


def test_closure_of_full_groups(spark):
    names = [f"t{k}" for k in range(9)]  # every tag depends on every other
    td = spark.createDataFrame([(t, [u for u in names if u != t]) for t in names], "tag string, on_off_dependencies array<string>")
    assert TG.dependency_closure(td).count() == 81
    assert TG.dependency_closure(td.limit(0)).count() == 0
