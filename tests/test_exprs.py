"""NULL / NaN / division rules on edge rows."""
from pyspark.sql import functions as F

from sensorloom.functions.exprs import clip, cut, nan_to_null, row_mean, row_sum, safe_div
from sensorloom.functions.naming import norm_name, parse_name


def test_division_rules(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (6.0, 3.0), (None, 2.0)], "n double, d double")
    out = df.select(safe_div("n", "d", fill=0).alias("a"), safe_div("n", "d").alias("b")).collect()
    assert [r.a for r in out] == [0.0, None, 2.0, None]
    assert [r.b for r in out] == [None, None, 2.0, None]


def test_row_mean_sum(spark):
    df = spark.createDataFrame([(None, None), (1.0, None), (1.0, 3.0)], "a double, b double")
    out = df.select(row_mean(["a", "b"]).alias("m"), row_sum(["a", "b"]).alias("s")).collect()
    assert [r.m for r in out] == [None, 1.0, 2.0]
    assert [r.s for r in out] == [0.0, 1.0, 4.0]


def test_cut_clip_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (5.0,), (50.0,), (None,)], "x double")
    out = df.select(nan_to_null("x").alias("n"), cut("x", 0, 10).alias("c"),
                    clip("x", 0, 10).alias("k")).collect()
    assert out[0].n is None
    assert [r.c for r in out[1:]] == [5.0, None, None]
    assert [r.k for r in out[1:]] == [5.0, 10.0, None]


def test_names():
    assert parse_name("Click: Rate") == "click__rate"
    assert parse_name("View-Rate.PV") == "view_rate_pv"
    assert norm_name(" A (B)+C ") == "a__b__c"
