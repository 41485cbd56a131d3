"""Registered queries: transformers fitted on one part of the rows and applied to the other (§2.14, PRJ13)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from sensorloom.operators import transformers as T
from sensorloom.plans.common import SQL_HOURLY, finish, register, sql_r
from sensorloom.sources import fixtures as FX

SPLIT = "2024-01-21 00:00:00"
COLS = ["click", "error", "purchase"]


def _rows(spark, sf_dir):
    """The hourly table with a column that is empty, and one that is sparse, before the split only."""
    h = FX.hourly_wide(spark, sf_dir)
    train = F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz")
    return h.withColumns({"late": F.when(~train, F.col("view")), "sparse": F.when(~train | (F.hour("ts") < 2), F.col("signup")),
                          "note": F.lit("x")}), train


_TEST = f"""h AS ({SQL_HOURLY}), train AS (SELECT * FROM h WHERE ts < TIMESTAMP '{SPLIT}'), test AS (SELECT * FROM h WHERE ts >= TIMESTAMP '{SPLIT}')"""


def _pipeline_sql() -> str:
    q = ", ".join(f"quantile_cont({c}, 0.05) AS {c}_lo, quantile_cont({c}, 0.9) AS {c}_hi" for c in COLS)
    cut = lambda c: f"CASE WHEN {c} >= {c}_lo AND {c} <= {c}_hi THEN {c} END"
    cuts = ", ".join(f"{cut(c)} AS {c}" for c in COLS)
    meds = ", ".join(f"quantile_cont({c}, 0.5) AS {c}_m" for c in COLS)
    fills = ", ".join(f"CASE WHEN coalesce({c}, {c}_m) < 0 THEN 0.0 ELSE coalesce({c}, {c}_m) END AS {c}" for c in COLS)
    scales = ", ".join(f"avg({c}) AS {c}_c, stddev_samp({c}) AS {c}_s" for c in COLS)
    out = ", ".join(f"{sql_r(f'({c} - {c}_c) / {c}_s')} AS {c}" for c in COLS)
    return f"""WITH {_TEST},
q AS (SELECT {q} FROM train), train1 AS (SELECT ts, {cuts} FROM train, q), test1 AS (SELECT ts, {cuts} FROM test, q),
m AS (SELECT {meds} FROM train1), train2 AS (SELECT ts, {fills} FROM train1, m), test2 AS (SELECT ts, {fills} FROM test1, m),
s AS (SELECT {scales} FROM train2)
SELECT ts, {out} FROM test2, s"""


@register("fitted_pipeline", _pipeline_sql())
def fitted_pipeline(spark, sf_dir):
    """PRJ5–PRJ8, CLN5, CLN7, CLU1 in one Pipeline: fitted before the split, applied after it."""
    rows, train = _rows(spark, sf_dir)
    stages = [T.SelectColumns(regex="^(ts|click|error|purchase|late|sparse|note)$"), T.DropColumns(items="note"), T.DropAllNull(), T.DropSparse(percent=90.0),
              T.CutOutliers(columns=COLS, bottom=0.05, top=0.9), T.FillMedian(columns=COLS), T.ScaleColumns(columns=COLS)]
    model = Pipeline(stages=stages).fit(rows.where(train))
    return finish(model.transform(rows.where(~train)))


def _scaling_sql() -> str:
    def stats(stage, table):
        return " UNION ALL ".join(
            f"SELECT '{stage}' AS stage, '{c}' AS variable, count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS least, "
            f"quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q75, max({c}) AS most FROM {table}" for c in COLS)
    q = ", ".join(f"quantile_cont({c}, 0.5) AS {c}_c, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS {c}_s" for c in COLS)
    out = ", ".join(f"({c} - {c}_c) / {c}_s AS {c}" for c in COLS)
    names = ["mean", "std", "least", "q25", "median", "q75", "most"]
    return f"""WITH {_TEST}, s AS (SELECT {q} FROM train), scaled AS (SELECT {out} FROM test, s),
r AS ({stats("before", "test")} UNION ALL {stats("after", "scaled")})
SELECT stage, variable, n, {", ".join(f"{sql_r(n)} AS {n}" for n in names)} FROM r"""


@register("scaling_statistics", _scaling_sql())
def scaling_statistics(spark, sf_dir):
    """CLU1: robust scaling learned before the split, and the statistics of the later rows before and after it."""
    rows, train = _rows(spark, sf_dir)
    test = rows.where(~train)
    after = T.ScaleColumns(columns=COLS, method="robust").fit(rows.where(train)).transform(test)
    return finish(T.scaling_statistics(test, after, COLS))



@register("wrapped_scaler", f"""WITH {_TEST},
s AS (SELECT {", ".join(f"avg({c}) AS {c}_c, stddev_samp({c}) AS {c}_s" for c in COLS)} FROM train WHERE {" AND ".join(f"{c} IS NOT NULL" for c in COLS)}),
x AS (SELECT * FROM test)
SELECT x.ts, {", ".join(f"{sql_r(f'(x.{c} - s.{c}_c) / s.{c}_s')} AS {c}" for c in COLS)} FROM x, s""")
def wrapped_scaler(spark, sf_dir):
    """PRJ13: MLlib's StandardScaler on named columns, fitted before the split, applied after it."""
    from pyspark.ml.feature import StandardScaler
    rows, train = _rows(spark, sf_dir)
    model = T.fit_on_columns(StandardScaler(withMean=True, withStd=True), rows.where(train), COLS)
    return finish(model.transform(rows.where(~train)).select("ts", *COLS))
