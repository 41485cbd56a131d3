"""Halo buckets and carry scans equal a whole-series computation for any bucket size."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorloom.operators import windows as W


def _series(spark, n=300, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for tag in ("a", "b"):
        v = rng.normal(10, 3, n)
        v[rng.random(n) < 0.2] = np.nan
        v[100:140] = np.nan  # a long NULL run
        for i in range(n):
            rows.append((tag, i, None if np.isnan(v[i]) else float(v[i])))
    return spark.createDataFrame(rows, "tag string, pos long, value double")


def _pandas(df):
    return df.toPandas().sort_values(["tag", "pos"]).reset_index(drop=True)


@pytest.mark.parametrize("bucket", [7, 64, 4096])
def test_rolling_and_lags(spark, bucket):
    d = _series(spark)
    out = _pandas(W.positional(d, ["tag"], "pos", lambda w: {
        "r6": W.rolling_full_mean("value", 6, w), "l2": F.lag("value", 2).over(w),
        "f1": F.lead("value", 1).over(w)}, back=5, fwd=1, bucket_rows=bucket))
    ref = _pandas(d)
    g = ref.groupby("tag")["value"]
    assert np.allclose(out["r6"], g.transform(lambda s: s.rolling(6).mean()), equal_nan=True)
    assert np.allclose(out["l2"], g.shift(2), equal_nan=True)
    assert np.allclose(out["f1"], g.shift(-1), equal_nan=True)


@pytest.mark.parametrize("bucket", [7, 64, 4096])
def test_ffill_ewm_runs(spark, bucket):
    d = _series(spark)
    ref = _pandas(d)
    g = ref.groupby("tag")["value"]
    ff = _pandas(W.ffill(d.withColumn("f", F.col("value")), ["tag"], "pos", ["f"], bucket))
    assert np.allclose(ff["f"], g.ffill(), equal_nan=True)
    e = _pandas(W.ewm_mean(d, ["tag"], "pos", "value", 3.0, "e", bucket_rows=bucket))
    assert np.allclose(e["e"], g.transform(lambda s: s.ewm(halflife=3.0).mean()), equal_nan=True, atol=1e-9)
    mx = W.max_null_run(d, ["tag"], "pos", "value", bucket).toPandas().set_index("tag")["max_null_run"]
    for tag, s in ref.groupby("tag")["value"]:
        runs = s.isnull().astype(int).groupby(s.notnull().astype(int).cumsum()).sum()
        assert mx[tag] == runs.max()
