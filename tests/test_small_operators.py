"""Operators that no registered query calls, each against values worked out by hand."""
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sensorloom.functions import exprs as E
from sensorloom.operators import clean as C
from sensorloom.operators import cluster as CL
from sensorloom.operators import features as FE
from sensorloom.operators import joins as J
from sensorloom.operators import ml as M
from sensorloom.operators import optimize as O
from sensorloom.operators import projection as P
from sensorloom.operators import quality as Q
from sensorloom.operators import reports as R
from sensorloom.operators import resample as RS
from sensorloom.operators import tags as TG
from sensorloom.operators import windows as W

T0 = datetime(2024, 1, 1)


def hours(spark, n, value=float):
    return spark.createDataFrame([(T0 + timedelta(hours=k), value(k)) for k in range(n)], "ts timestamp_ntz, x double")


def test_dictionary_as_text_and_json(spark):
    schema = "tag string, name string, on_off_dependencies array<string>, op_min double"
    td = spark.createDataFrame([("a", "A", ["p", "q"], 1.5), ("b", None, [], None)], schema)
    flat = {r.tag: r for r in TG.to_frame(td).collect()}
    assert flat["a"].on_off_dependencies == "p, q" and flat["b"].on_off_dependencies == ""
    back = TG.from_json_records(TG.to_json_records(td), "name string, on_off_dependencies array<string>, op_min double")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, td.collect()))
    assert TG.common_tags(td, spark.createDataFrame([("b",), ("c",)], "tag string")).collect() == [("b",)]


def test_no_go_raises_and_names_its_tags(spark):
    td = spark.createDataFrame([("a", True, False), ("b", True, False), ("c", False, False)], "tag string, m_feature boolean, derived boolean")
    qa = spark.createDataFrame([("a", 1), ("b", 3), ("c", 5)], "tag string, score int")
    with pytest.raises(ValueError, match="m_feature score 3: b"):
        Q.go_or_no_go(qa, td, ["m_feature"], raise_on_no_go=True)
    good = Q.go_or_no_go(qa.where("tag <> 'b'"), td, ["m_feature"], raise_on_no_go=True)
    assert good.where("not go").count() == 0


def test_free_controls_follow_their_dependencies(spark):
    values = spark.createDataFrame([("r", "c", 1.0), ("r", "d", 2.0), ("r", "e", None), ("r", "on", 1.0), ("r", "off", 0.0)], "run_id string, tag string, value double")
    closure = spark.createDataFrame([("c", "on"), ("d", "on"), ("d", "off")], "tag string, dependency string")
    controls = spark.createDataFrame([("c",), ("d",), ("e",)], "tag string")
    assert {r.tag: r.free for r in O.free_controls(values, controls, closure).collect()} == {"c": True, "d": False, "e": False}


def test_windows_and_timestamps(spark):
    df = hours(spark, 48)
    wins = spark.createDataFrame([(1, T0, T0 + timedelta(hours=2)), (2, T0 + timedelta(hours=1), T0 + timedelta(hours=1))], "id int, a timestamp_ntz, b timestamp_ntz")
    got = J.in_windows(df, wins, "ts", "a", "b", 86400, ["id"]).groupBy("id").count().collect()
    assert {r.id: r["count"] for r in got} == {1: 3, 2: 1}
    stamps = spark.createDataFrame([(T0,), (T0,), (datetime(2030, 1, 1),)], "ts timestamp_ntz")
    assert J.keep_timestamps(df, stamps).count() == 1


def test_four_hour_bins_start_at_23(spark):
    got = RS.four_hour_mean(hours(spark, 12)).orderBy("ts").collect()
    assert [(r.ts.hour, r.x) for r in got] == [(23, 1.0), (3, 4.5), (7, 8.5), (11, 11.0)]


def test_column_rules(spark):
    df = spark.createDataFrame([(1, 2.5, 0.0), (2, -7.0, 1.0), (3, None, None)], "id int, x double, gate double")
    assert [r.x for r in C.replace_outliers_by_value(df, {"x": {"low_value": -1.0, "high_value": 2.0}}).orderBy("id").collect()] == [2.0, -1.0, None]
    assert [r.y for r in df.select("id", E.zero_while("x", "gate").alias("y")).orderBy("id").collect()] == [2.5, 0.0, None]
    assert [r[0] for r in spark.createDataFrame([(0.125,), (0.375,)], "v double").select(C.round_for_counting("v", 2)).collect()] == [0.12, 0.38]
    assert df.select(P.convert("x", P.M3H_PER_LS)).first()[0] == 9.0 and df.select(P.convert("x", P.PER_CENT, divide=True)).first()[0] == 0.025
    assert df.where("id = 1").select(FE.reagent_dosing("x", ["x"], 0.5, 1.0, 0, 100)).first()[0] == 30.0
    shares = FE.proportions(["x", "gate"])
    assert df.where("id = 2").select(shares["gate_prop"]).first()[0] == pytest.approx(-1 / 6)
    w = Window.orderBy("id")
    assert [r[0] for r in df.select(W.rolling_mean("x", 2, w, 1)).collect()] == [2.5, -2.25, -7.0]


def test_cluster_sizes_and_means(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 10.0), (2, None)], "c int, m double")
    assert {r.c: (r.size, r.mean_m) for r in CL.cluster_summary(df, "c", ["m"]).collect()} == {1: (0.5, 2.0), 2: (0.5, 10.0)}


def test_ascending(spark):
    df = hours(spark, 5).withColumns({"k": F.lit(0), "pos": F.col("x").cast("long")})
    R.assert_ascending(df, ["k"], "pos")
    with pytest.raises(ValueError):
        R.assert_ascending(df.withColumn("pos", 4 - F.col("pos")), ["k"], "pos")


def test_batch_job_on_a_stream(spark):
    from sensorloom.session import scratch_path
    from sensorloom.streaming import run_batch_job_on_stream
    folder = scratch_path(spark, "stream")
    hours(spark, 30).write.parquet(folder + "/in")
    stream = spark.readStream.schema("ts timestamp_ntz, x double").parquet(folder + "/in")
    run_batch_job_on_stream(stream, lambda b: RS.four_hour_mean(b), folder + "/out", folder + "/state").awaitTermination(120)
    assert spark.read.parquet(folder + "/out").select("ts", "x").exceptAll(RS.four_hour_mean(hours(spark, 30))).count() == 0


def test_training_at_a_cut_date(spark):
    df = hours(spark, 60, lambda k: float(k % 7)).withColumn("y", F.col("x") * 2)
    model, rows, results = M.tune_at_cut(df, "ts", T0 + timedelta(hours=40), ["x"], "y", "gbt", {"maxIter": [1, 3], "maxDepth": [2]}, n_splits=2)
    split = {r.split: r["count"] for r in rows.groupBy("split").count().collect()}
    assert split == {"train": 40, "test": 20} and "prediction" in rows.columns
    assert results.count() == 4 and results.agg(F.max("fold")).first()[0] == 1
