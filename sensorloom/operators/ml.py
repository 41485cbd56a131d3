"""Modelling (ML1–ML17, AGG13) on Spark MLlib.

* Splits and time folds are columns computed from a dense time index —
  no driver-side slicing, no global sort into one task.
* Metrics are one SQL aggregate (scikit-learn definitions; note Spark's
  ``RegressionEvaluator("var")`` is a different quantity).
* Fitting uses ``pyspark.ml`` pipelines (Imputer → VectorAssembler →
  regressor); hyper-parameter search evaluates every (draw, fold) pair and
  trains each fold only on **earlier** rows (an expanding time split —
  ``CrossValidator(foldCol)`` would also train on later folds).
* One model per unit runs the same pipeline per key from a bounded pool of
  driver threads; every fit itself is a distributed MLlib job.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.exprs import safe_div
from sensorloom.operators.windows import dense_index
from sensorloom.session import written


# ------------------------------------------------------------------ splits
def split_by_date(df: DataFrame, ts_col: str, split: datetime) -> dict[str, DataFrame]:
    """ML1: ``train = ts ≤ split``, ``test = ts > split``; error when the split
    lies outside the data's time range (one min/max aggregate)."""
    b = df.agg(F.min(ts_col).alias("lo"), F.max(ts_col).alias("hi")).first()
    if b["lo"] is None or not (b["lo"] <= split <= b["hi"]):
        raise ValueError(f"split {split} lies outside [{b['lo']}, {b['hi']}]")
    s = F.lit(split).cast("timestamp_ntz")
    return {"train": df.where(F.col(ts_col) <= s), "test": df.where(F.col(ts_col) > s)}


def split_by_frac(df: DataFrame, ts_col: str, train_fraction: float) -> dict[str, DataFrame]:
    """ML2: first ``int(n · f)`` rows in time order are train, the rest test.

    The row position comes from :func:`dense_index`, so no single task sorts the table.
    """
    n = df.count()
    cut = int(n * train_fraction)
    d = dense_index(df.withColumn("_k", F.lit(0)), ["_k"], ts_col, "_pos")
    return {"train": d.where(F.col("_pos") < cut).drop("_k", "_pos"),
            "test": d.where(F.col("_pos") >= cut).drop("_k", "_pos")}


def time_folds(df: DataFrame, ts_col: str, n_splits: int = 5) -> DataFrame:
    """ML5 folds: adds ``fold`` = test block of an expanding time split.

    Same blocks as scikit-learn ``TimeSeriesSplit``: ``test_size = n //
    (n_splits + 1)``; block ``k`` (0-based) tests rows
    ``[n − (n_splits − k)·size, … + size)`` and trains on all earlier rows.
    Rows before the first test block get ``fold = -1`` (train only).
    """
    n = df.count()
    size = n // (n_splits + 1)
    first = n - n_splits * size
    d = dense_index(df.withColumn("_k", F.lit(0)), ["_k"], ts_col, "_pos")
    fold = F.when(F.col("_pos") < first, F.lit(-1)).otherwise(
        F.floor((F.col("_pos") - F.lit(first)) / F.lit(size)).cast("int"))
    return d.withColumn("fold", fold).withColumn("_pos_t", F.col("_pos")).drop("_k", "_pos")


# ------------------------------------------------------------------ metrics
def regression_metrics(df: DataFrame, y: str, yhat: str, keys: Sequence[str] = ()) -> DataFrame:
    """AGG13: MAE, RMSE, MSE, MAPE (over ``y ≠ 0``, signed ``y``), R²,
    explained variance ``1 − var_pop(y − ŷ)/var_pop(y)``, means — one aggregate."""
    e = F.col(y) - F.col(yhat)
    g = df.groupBy(*keys) if keys else df.groupBy()
    m = g.agg(
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("mse"),
        (F.lit(100.0) * F.avg(F.when(F.col(y) != 0, F.abs(e) / F.col(y)))).alias("mape"),
        F.sum(e * e).alias("_sse"),
        (F.var_pop(F.col(y)) * F.count(F.col(y))).alias("_sst"),
        F.var_pop(e).alias("_ve"), F.var_pop(F.col(y)).alias("_vy"),
        F.avg(F.col(y)).alias("mean_true"), F.avg(F.col(yhat)).alias("mean_pred"))
    return m.select(*keys, "mae", F.sqrt("mse").alias("rmse"), "mse", "mape",
                    (F.lit(1.0) - safe_div("_sse", "_sst")).alias("r2"),
                    (F.lit(1.0) - safe_div("_ve", "_vy")).alias("var_score"),
                    "mean_true", "mean_pred")


# ------------------------------------------------------------------ models
REGRESSORS = {"gbt": GBTRegressor, "rf": RandomForestRegressor, "linear": LinearRegression}


def load_regressor(kind: str, **params):
    """ML4 ``load_regressor``: registry of MLlib regressors (replaces class paths)."""
    return REGRESSORS[kind](featuresCol="features", labelCol="label", **params)


def build_pipeline(features: Sequence[str], regressor) -> Pipeline:
    """ML4 ``add_transformers``: select features → median impute → assemble → regress.

    GBT rejects NULL features (XGBoost accepts them), so imputation is part
    of the pipeline and is refit with it."""
    imp_out = [f"_imp_{c}" for c in features]
    return Pipeline(stages=[
        Imputer(inputCols=list(features), outputCols=imp_out, strategy="median"),
        VectorAssembler(inputCols=imp_out, outputCol="features", handleInvalid="keep"),
        regressor,
    ])


def fit(df: DataFrame, features: Sequence[str], target: str, regressor) -> PipelineModel:
    """ML8 ``retrain``: fit the pipeline with fixed parameters."""
    return build_pipeline(features, regressor).fit(df.withColumn("label", F.col(target).cast("double")))


def predict(model: PipelineModel, df: DataFrame, out_col: str = "prediction") -> DataFrame:
    """ML7: predictions; helper columns of the pipeline are dropped."""
    p = model.transform(df)
    drop = [c for c in p.columns if c.startswith("_imp_") or c in ("features", "label")]
    return p.drop(*drop).withColumnRenamed("prediction", out_col) if out_col != "prediction" \
        else p.drop(*drop)


def feature_importance(model: PipelineModel, features: Sequence[str], spark, top: int = 20) -> DataFrame:
    """ML9 + TOP2: tree feature importances, largest ``top`` first."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(features, [float(x) for x in imp])), "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature").limit(top)


def sample_params(space: Mapping[str, Sequence], draws: int, seed: int = 0) -> list[dict]:
    """Random-search draws from a discrete space, none twice (deterministic by seed); at most the whole space."""
    keys = sorted(space)
    every = [dict(zip(keys, v)) for v in itertools.product(*[list(space[k]) for k in keys])]
    return random.Random(seed).sample(every, min(draws, len(every)))


def tune(df: DataFrame, ts_col: str, features: Sequence[str], target: str, kind: str,
         space: Mapping[str, Sequence], draws: int = 300, n_splits: int = 5, seed: int = 0,
         threads: int = 4) -> tuple[PipelineModel, DataFrame]:
    """ML5/ML6: random search with an expanding time split, refit on all rows by RMSE.

    Returns ``(best model, results (draw, params, fold, rmse))``.  Draws that
    differ only in the number of boosting rounds share one fit of the longest: a
    model's first trees are those of a shorter one, so all lengths are scored from it in
    one pass.  The (group, fold) fits run concurrently from a bounded thread pool;
    each is a distributed MLlib fit on the written fold table.  A draw that no
    fold could score never wins.
    """
    folded = written(time_folds(df, ts_col, n_splits), "folds")
    draws_p = sample_params(space, draws, seed)
    groups: dict[tuple, list[int]] = {}
    for i, p in enumerate(draws_p):
        rest = tuple(sorted((k, v) for k, v in p.items() if kind != "gbt" or k != "maxIter"))
        groups.setdefault(rest, []).append(i)

    def run(task: tuple[tuple, int]) -> list[tuple]:
        rest, k = task
        mine = groups[rest]
        longest = max(mine, key=lambda i: draws_p[i].get("maxIter", 0))
        train, test = folded.where(F.col("fold") < k), folded.where((F.col("fold") == k) & F.col(target).isNotNull())
        model = fit(train.where(F.col(target).isNotNull()), features, target, load_regressor(kind, **draws_p[longest]))
        if kind == "gbt":
            vectors = PipelineModel(model.stages[:-1]).transform(test.withColumn("label", F.col(target).cast("double")))
            mse = [] if vectors.isEmpty() else model.stages[-1].evaluateEachIteration(vectors, "squared")
            rmse = {i: mse[draws_p[i].get("maxIter", len(mse)) - 1] ** 0.5 if mse else None for i in mine}
        else:
            r = regression_metrics(predict(model, test), target, "prediction").first()
            rmse = {i: r["rmse"] for i in mine}
        return [(i, str(draws_p[i]), k, rmse[i]) for i in mine]

    with ThreadPoolExecutor(max_workers=threads) as ex:
        res = [r for part in ex.map(run, itertools.product(groups, range(n_splits))) for r in part]
    results = df.sparkSession.createDataFrame(sorted(res, key=lambda r: (r[0], r[2])), "draw int, params string, fold int, rmse double")

    def mean_rmse(i: int) -> float:
        got = [r[3] for r in res if r[0] == i and r[3] is not None]
        return sum(got) / len(got) if got else float("inf")
    best_i = min(range(len(draws_p)), key=mean_rmse)
    best = fit(folded.where(F.col(target).isNotNull()), features, target, load_regressor(kind, **draws_p[best_i]))
    return best, results


def tune_at_cut(df: DataFrame, ts_col: str, cut: datetime, features: Sequence[str], target: str, kind: str,
                space: Mapping[str, Sequence], draws: int = 500, n_splits: int = 5, seed: int = 0) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """ML15: the search on the rows before ``cut``, and its winner's predictions for all rows.

    Returns ``(model, rows with split and prediction, search results)``; rows from ``cut`` on are ``test``."""
    before = F.col(ts_col) < F.lit(cut).cast("timestamp_ntz")
    model, results = tune(df.where(before), ts_col, features, target, kind, space, draws, n_splits, seed)
    rows = predict(model, df.withColumn("split", F.when(before, "train").otherwise("test")))
    return model, rows, results


def model_per_unit(df: DataFrame, unit_col: str, units: Sequence, features: Sequence[str],
                   target: str, kind: str, params: Mapping | None = None,
                   threads: int = 4) -> dict:
    """ML17: the same pipeline fitted once per unit (concurrent driver threads)."""
    params = dict(params or {})

    def run(u):
        return u, fit(df.where(F.col(unit_col) == F.lit(u)), features, target,
                      load_regressor(kind, **params))
    with ThreadPoolExecutor(max_workers=threads) as ex:
        return dict(ex.map(run, units))


def residuals(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """ML12: residual column (the data behind residual and prediction plots)."""
    return df.withColumn("residual", F.col(y) - F.col(yhat))


def baseline_predictions(df: DataFrame, y: str, train_mean: float, prev_col: str) -> DataFrame:
    """ML14: mean-of-train and previous-value baselines as prediction columns."""
    return df.select("*", F.lit(float(train_mean)).alias("pred_mean"),
                     F.col(prev_col).alias("pred_prev"))
