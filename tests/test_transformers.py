"""Fit on train, apply to test, save and load."""
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler
from pyspark.sql import functions as F

from sensorloom.operators import clean
from sensorloom.operators import transformers as T
from sensorloom.session import scratch_path


@pytest.fixture(scope="module")
def rows(spark):
    data = [(k, float(k * 7 % 50) if k % 5 else None, float(1000 if k == 3 else k % 11), None if k < 40 else 1.0, 1.0 if k % 10 == 0 else None, "t") for k in range(60)]
    return spark.createDataFrame(data, "k int, a double, b double, empty double, sparse double, name string")


def stages():
    return [T.DropColumns(regex="^name$"), T.DropAllNull(), T.DropSparse(percent=60.0), T.CutOutliers(columns=["a"], bottom=0.1, top=0.8), T.CapOutliers(columns=["b"]),
            T.FillMedian(columns=["a", "b"]), T.ScaleColumns(columns=["a", "b"], method="robust")]


def test_state_comes_from_the_training_rows(spark, rows):
    train, test = rows.where("k < 40"), rows.where("k >= 40")
    model = Pipeline(stages=stages()).fit(train)
    got = model.transform(test)
    assert got.columns == ["k", "a", "b"]  # 'empty' has values later, and still goes
    t, u = train.toPandas(), test.toPandas()
    lo, hi = t.a.quantile(0.1), t.a.quantile(0.8)
    cut = lambda x: x.where((x >= lo) & (x <= hi))
    fill = cut(t.a).median()
    at, au = cut(t.a).fillna(fill), cut(u.a).fillna(fill)
    want = (au - at.median()) / (at.quantile(0.75) - at.quantile(0.25))
    assert [r.a for r in got.orderBy("k").collect()] == pytest.approx(want.tolist())
    # equal to the operators where train and test are the same rows
    same = T.CapOutliers(columns=["b"]).fit(train).transform(train).select("k", "b")
    assert same.exceptAll(clean.remove_outliers_esp(train, ["b"]).select("k", "b")).count() == 0


def test_saved_models_and_pipelines_give_the_same(spark, rows):
    train, test = rows.where("k < 40"), rows.where("k >= 40")
    pipeline = Pipeline(stages=[T.SelectColumns(regex="^(k|a|b|name)$"), *stages()])
    model = pipeline.fit(train)
    folder = scratch_path(spark, "stages")
    model.write().save(folder + "/model")
    pipeline.write().save(folder + "/pipeline")
    want = model.transform(test)
    for got in (PipelineModel.load(folder + "/model").transform(test), Pipeline.load(folder + "/pipeline").fit(train).transform(test)):
        assert got.columns == want.columns and got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_mllib_stage_keeps_names(spark, rows):
    train, test = rows.where("k < 40"), rows.where("k >= 40")
    model = T.fit_on_columns(MinMaxScaler(), train, ["a", "b"])
    folder = scratch_path(spark, "wrapped")
    model.write().save(folder)
    out = PipelineModel.load(folder).transform(test)
    assert out.columns == test.columns
    t = train.toPandas().dropna(subset=["a", "b"])
    want = (test.toPandas().a - t.a.min()) / (t.a.max() - t.a.min())
    got = pd.Series([r.a for r in out.orderBy("k").collect()], dtype=float)
    pd.testing.assert_series_equal(got, want, check_names=False)
    assert out.where(F.col("a").isNull()).count() == test.where(F.col("a").isNull()).count() > 0


def test_no_rows_and_no_spread(spark):
    none = spark.createDataFrame([], "a double, b double")
    assert T.ScaleColumns().fit(none).transform(none).count() == 0
    assert T.FillMedian().fit(none).transform(spark.createDataFrame([(None, -1.0)], "a double, b double")).first() == (None, 0.0)
    flat = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "a double, b double")
    assert {r.a for r in T.ScaleColumns(method="robust").fit(flat).transform(flat).collect()} == {2.0}


@pytest.mark.parametrize("make", [lambda: T.SelectColumns(items=["a"], regex="b"), lambda: T.ScaleColumns(method="odd")])
def test_wrong_settings(make):
    with pytest.raises(ValueError):
        make()


def test_only_frames():
    with pytest.raises(TypeError):
        T.DropAllNull().fit(pd.Series([1.0]))
    with pytest.raises(TypeError):
        T.KeepModel.of(["a"]).transform([1])
