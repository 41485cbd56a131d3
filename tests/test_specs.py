"""Feature specs: order, passes, errors."""
import pytest
from pyspark.sql import functions as F

from sensorloom.operators import specs as S


def plan(n):
    """``n`` chains of row, window, weighted mean, window."""
    out = []
    for k in range(n):
        out += [S.lagged(f"d{k}", f"c{k}", 2), S.weighted_mean(f"c{k}", f"b{k}", 3.0), S.rolling(f"b{k}", f"a{k}", 3), S.row(f"a{k}", ["x"], lambda k=k: F.col("x") * (k + 1))]
    return out


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_exchanges_do_not_grow_with_features(spark):
    df = spark.range(50).selectExpr("cast(id % 2 as int) as k", "id div 2 as pos", "cast(id as double) as x")
    one, many = (S.compile_features(df, plan(n), ["k"], "pos", 8) for n in (1, 12))
    assert exchanges(one) == exchanges(many) > 0
    same = one.join(many.select("k", "pos", F.col("d0").alias("m")), ["k", "pos"])
    assert same.where("not (d0 <=> m)").count() == 0 and same.where("d0 is not null").count() > 20


def test_passes_follow_the_inputs():
    got = S.passes(plan(1), ["x"])
    assert [([[f.name for f in level] for level in rows], [f.name for f in w], [f.name for f in m]) for rows, w, m in got] == [
        ([["a0"]], ["b0"], []), ([], [], ["c0"]), ([], ["d0"], [])]


@pytest.mark.parametrize("features, said", [
    ([S.lagged("a", "b", 1), S.lagged("b", "a", 1)], "need each other"),
    ([S.lagged("a", "nowhere", 1)], "no such input"),
    ([S.lagged("x", "x", 1)], "made twice"),
])
def test_wrong_specs_are_refused(features, said):
    with pytest.raises(ValueError, match=said):
        S.passes(features, ["x"])


def test_fill_comes_before_the_targets(spark):
    df = spark.createDataFrame([(0, p, c, 1.0, 0.1) for p, c in enumerate([30.0, None, None, None, 25.0, None])], "k int, pos long, conc double, feed double, t double")
    out = S.compile_features(df, S.flotation_features("conc", "feed", ["t"], [1.0], "f"), ["k"], "pos", 4, keep=["f_recup_wt", "f_recup_l1", "f_recup_peso_l1"])
    got = [r.f_recup_wt for r in out.orderBy("pos").collect()]
    want = [c * 0.9 / (c - 0.1) if c else None for c in [30.0, 30.0, 25.0, 25.0, 25.0, 25.0]]
    assert got == pytest.approx(want)
