"""Rules that the oracles do not reach: infinities, far clusters, screens with gaps, exact quantiles, run-wise control search."""
import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.operators import cluster as C
from sensorloom.operators import expect as X
from sensorloom.operators import filters as FL
from sensorloom.operators import joins as J
from sensorloom.operators import optimize as O
from sensorloom.operators import projection as P
from sensorloom.operators import quality as Q
from sensorloom.operators.quantiles import column_quantiles, exact_quantiles

INF = float("inf")


def test_envelope_filter_clears_infinities(spark):
    df = spark.createDataFrame([(1.0, INF), (2.0, -INF), (3.0, 4.0), (99.0, 1.0), (None, 1.0)], "a double, b double")
    assert sorted(FL.envelope_filter(df, {"a": (0, 10)}).collect()) == [(1.0, None), (2.0, None), (3.0, 4.0)]


def test_listed_timestamps(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([(t, 1)], "ts timestamp_ntz, v int")
    assert FL.filter_timestamp_optimization(df, mode="list", stamps=[t]).count() == 1
    with pytest.raises(ValueError):
        FL.filter_timestamp_optimization(df, mode="list", stamps=[t + timedelta(1)])


def test_first_row_without_order_is_the_smallest(spark):
    df = spark.createDataFrame([("2024", 3.0, 1.0), ("2024", 2.0, 9.0), ("2025", 1.0, 1.0)], "T string, `A.B` double, c double")
    for n in (1, 4):
        got = P.parse_and_coerce(df.repartition(n), "T")
        assert sorted(tuple(r) for r in got.collect()) == [("2024", 2.0, 9.0), ("2025", 1.0, 1.0)]


def test_far_clusters(spark):
    rng = random.Random(0)
    rows = [(lab, rng.gauss(m, 1), rng.gauss(m, 2)) for lab, m in ((1, 0), (2, 1000)) for _ in range(40)]
    out = C.kl_metrics(spark.createDataFrame(rows, "lab int, x double, y double"), ["x"], ["y"], "lab").first()
    assert math.isfinite(out.kl_div_total) and out.kl_div_total > 1e4


def test_ks_share_counts_windows_without_data(spark):
    d0 = datetime(2024, 1, 1)
    rows = [("t", d0 + timedelta(hours=h), float(h < 24 * 4)) for h in range(24 * 9)]
    rows.append(("t", d0 + timedelta(days=40), 1.0))
    long = spark.createDataFrame(rows, "tag string, ts timestamp_ntz, value double")
    windows = spark.createDataFrame([(d0, d0 + timedelta(3), d0 + timedelta(4), d0 + timedelta(8)),
                                     (d0 + timedelta(20), d0 + timedelta(23), d0 + timedelta(24), d0 + timedelta(28))],
                                    "start1 timestamp_ntz, end1 timestamp_ntz, start2 timestamp_ntz, end2 timestamp_ntz")
    ks = Q.ks_stability(long, windows)
    assert [r.ks for r in ks.collect()] == [1.0]
    assert [r.pct_unstable for r in Q.ks_summary(ks, windows).collect()] == [50.0]


def test_interval_exclusion(spark):
    d0 = datetime(2024, 1, 1)
    df = spark.createDataFrame([(d0 + timedelta(hours=6 * h),) for h in range(40)], "ts timestamp_ntz")
    iv = spark.createDataFrame([(d0 + timedelta(days=1), d0 + timedelta(days=3)), (d0 + timedelta(days=2), d0 + timedelta(days=2, hours=5))],
                               "start_ts timestamp_ntz, end_ts timestamp_ntz")
    kept = [r.ts for r in J.exclude_intervals(df, iv).collect()]
    assert len(kept) == 31 and not any(d0 + timedelta(1) <= t <= d0 + timedelta(3) for t in kept)


@pytest.mark.parametrize("n", [1, 2, 3, 1000])
def test_exact_quantiles(spark, n):
    rng = np.random.default_rng(n)
    x = np.round(rng.normal(size=n), 1)
    df = spark.createDataFrame([(str(i % 2), float(v)) for i, v in enumerate(x)] + [("0", None), ("n", None)], "k string, v double")
    qs = [0.0, 0.1, 0.25, 0.5, 0.95, 1.0]
    got = {r.k: list(r[1:]) for r in exact_quantiles(df, ["k"], "v", qs).collect()}
    assert set(got) == {str(i % 2) for i in range(n)}
    for k, v in got.items():
        assert v == pytest.approx(np.quantile(x[int(k)::2], qs).tolist())
    assert column_quantiles(df, ["v"], [0.5])["v"] == pytest.approx([np.quantile(x, 0.5)])


def test_isolation_forest_finds_outliers(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(400, 2)))]
    rows += [(1000 + i, 8.0 + i, -9.0) for i in range(4)] + [(2000, None, 1.0)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    one, two = ({r.id: (r.iso_score, r.anomaly) for r in X.isolation_forest(d, ["a", "b"], contamination=0.01).collect()}
                for d in (df, df.repartition(7)))
    assert one == two and len(one) == len(rows) and one[2000] == (None, None)
    assert {i for i, (_, a) in one.items() if a} >= {1000, 1001, 1002, 1003}


def test_kmeans_keeps_rows_with_gaps(spark):
    df = spark.createDataFrame([(1.0, 1.0)] * 5 + [(50.0, 50.0)] + [(None, 1.0)], "a double, b double")
    rows = X.kmeans_anomaly(df, ["a", "b"]).collect()
    assert len(rows) == 7 and sum(r.anomaly is None for r in rows) == 1 and [r.a for r in rows if r.anomaly] == [50.0]


def test_control_search_respects_each_run(spark):
    td = spark.createDataFrame([("x", 0.0, 100.0, 5.0, None), ("y", 0.0, 10.0, None, "[1, 4, 9]"), ("z", 0.0, 1.0, None, None)],
                               "tag string, op_min double, op_max double, max_delta double, constraint_set string")
    closure = spark.createDataFrame([("z", "on")], "tag string, dependency string")
    runs = spark.createDataFrame([("a", 10.0, 2.0, 0.5, 1.0), ("b", 200.0, None, 0.5, 0.0), ("c", 60.0, 4.0, None, 1.0)],
                                 "run_id string, x double, y double, z double, on double")
    obj = O.expression_objective(F.col("x") - F.coalesce(F.abs(F.col("y") - 5.2), F.lit(0.0)) + F.coalesce("z", F.lit(0.0)))
    got = {r.run_id: r for r in O.search_controls(runs, td, closure, ["x", "y", "z"], obj, max_gen=12).collect()}
    assert got["a"].new_x == pytest.approx(15, abs=0.5) and got["a"].new_x <= 15 and got["a"].new_y == 4.0 and got["a"].new_z > 0.8
    assert got["b"].new_x == 100.0 and got["b"].new_y is None and got["b"].new_z == 0.5 and not got["b"].free_z
    assert got["c"].new_z is None and 55 <= got["c"].new_x <= 65


def test_ranges_and_uplift(spark):
    td = spark.createDataFrame([("a", "[-1.5, 2.7]", None, None, None, None)],
                               "tag string, constraint_set string, op_min double, op_max double, range_min double, range_max double")
    assert O.control_range(td).first()["values"] == [-1.0, 2.0]
    with pytest.raises(ValueError):
        O.sensitivity(spark.createDataFrame([("r", 1.0)], "run_id string, a double"), td.withColumn("constraint_set", F.lit(None).cast("string")).transform(O.control_range),
                      O.expression_objective(F.col("a")))
    rec = spark.createDataFrame([("r", datetime(2024, 1, 1), -100.0, -50.0)], "run_id string, ts timestamp_ntz, objective_current double, objective_suggested double")
    up = O.uplift(rec, spark.createDataFrame([("r", -200.0)], "run_id string, actual double")).first()
    assert (up.uplift_pred, up.uplift_pred_pct, up.uplift_actual, up.uplift_actual_pct) == (50.0, -50.0, 150.0, -75.0)


def test_written_tables_and_discard(spark):
    from sensorloom.session import discard, written
    df = spark.range(10).selectExpr("id", "id % 2 AS k")
    t = written(df, "numbers")
    assert t.dtypes == df.dtypes and t.count() == 10
    discard(t)
    with pytest.raises(Exception):
        t.count()
    with pytest.raises(ValueError):
        discard(spark.read.parquet("/root/testdata/sf0.001/region.parquet"))
    assert written(df.limit(0), "none").count() == 0
