"""Sums of products in one scan: wide correlations (ML16) and linear models of all units (ML17).

A task turns its rows into a matrix and adds up products of matrices, so the plan holds no expression for a
pair of columns.  What leaves a task are sums, one row per unit (or column) and task; they are
added by key.  A model is solved from its unit's sums, and scored from the sums of the rows it is tested on.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.operators.windows import dense_index
from sensorloom.session import written


def _finite(pdf: pd.DataFrame, cols: Sequence[str]) -> np.ndarray:
    x = pdf[list(cols)].to_numpy(dtype=np.float64, na_value=np.nan)
    return np.where(np.isfinite(x), x, np.nan)


# ------------------------------------------------------------------ correlation
PARTS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def pair_sums(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``i`` and arrays ``n, sx, sy, sxx, syy, sxy`` over the columns j: sums over the rows where columns i and j both have a number.

    Values are taken relative to the column's mean, so that large levels do not eat the digits."""
    cols = list(cols)
    doubles = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(cols)])
    names = doubles.columns
    means = doubles.agg(*[F.avg(F.when(F.abs(c) < float("inf"), F.col(c))).alias(c) for c in names]).first()  # one row
    centre = np.array([0.0 if means[c] is None else means[c] for c in names])
    kind = ", ".join(["i int", *[f"{p} array<double>" for p in PARTS]])

    def rows_of(t: dict) -> pd.DataFrame:
        return pd.DataFrame({"i": np.arange(len(names), dtype=np.int32), **{p: list(t[p]) for p in PARTS}})

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            x = _finite(pdf, names) - centre
            there = np.isfinite(x)
            x, there = np.where(there, x, 0.0), there.astype(np.float64)
            now = {"n": there.T @ there, "sx": x.T @ there, "sy": there.T @ x, "sxx": (x * x).T @ there, "syy": there.T @ (x * x), "sxy": x.T @ x}
            total = now if total is None else {p: total[p] + now[p] for p in PARTS}
        if total is not None:
            yield rows_of(total)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, list] = {}
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                mine = [np.asarray(getattr(r, p)) for p in PARTS]
                total[r.i] = mine if r.i not in total else [a + b for a, b in zip(total[r.i], mine)]
        if total:
            yield pd.DataFrame({"i": np.array(list(total), dtype=np.int32), **{p: [v[k] for v in total.values()] for k, p in enumerate(PARTS)}})
    return doubles.mapInPandas(products, kind).repartition("i").mapInPandas(add, kind)


def correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """ML16: ``(var_a, var_b, corr)``, the Pearson correlation of every two columns over the rows where both have a number;
    NULL where there are fewer than two such rows or one column does not vary over them."""
    names = F.array(*[F.lit(c) for c in cols])
    cells = pair_sums(df, cols).select("i", F.posexplode(F.arrays_zip(*PARTS)).alias("j", "c")).select("i", "j", "c.*")
    vx = F.col("n") * F.col("sxx") - F.col("sx") ** 2
    vy = F.col("n") * F.col("syy") - F.col("sy") ** 2
    # a column that is constant leaves a rest of rounding only
    tiny = 1e-12
    varies = (F.col("n") >= 2) & (vx > tiny * F.col("n") * F.col("sxx")) & (vy > tiny * F.col("n") * F.col("syy"))
    r = (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / F.sqrt(vx * vy)
    return cells.select(names[F.col("i")].alias("var_a"), names[F.col("j")].alias("var_b"),
                        F.when(varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("corr"))


# ------------------------------------------------------------------ linear models
def gram_sums(df: DataFrame, keys: Sequence[str], features: Sequence[str], target: str) -> DataFrame:
    """``keys, cell, s``: the sums of products of ``(1, features, target)`` per key, the matrix row by row; rows with a missing number are left out."""
    keys, names = list(keys), [*features, target]
    size = len(names) + 1
    schema = df.select(*keys).schema
    kind = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields], "gram array<double>"])
    rows = df.select(*keys, *[F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(names)])

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = _finite(pdf, [f"c{k}" for k in range(len(names))])
            good = np.isfinite(x).all(axis=1)
            pdf, x = pdf[good].reset_index(drop=True), np.column_stack([np.ones(good.sum()), x[good]])
            out = []
            for key, at in pdf.groupby(keys, dropna=False, sort=False).indices.items():
                out.append((*(key if isinstance(key, tuple) else (key,)), (x[at].T @ x[at]).ravel()))
            if out:
                yield pd.DataFrame({k: pd.Series([o[n] for o in out], dtype=pdf[k].dtype) for n, k in enumerate(keys)} | {"gram": [o[-1] for o in out]})
    parts = rows.mapInPandas(products, kind).select(*keys, F.posexplode("gram").alias("cell", "s"))
    return parts.groupBy(*keys, "cell").agg(F.sum("s").alias("s")).withColumn("size", F.lit(size))


def solve(gram: np.ndarray) -> np.ndarray | None:
    """Coefficients (constant first) of the last column on the others from their sums of products; None without rows."""
    n = gram[0, 0]
    if n < 1:
        return None
    mean = gram[0] / n
    spread = gram - np.outer(mean, mean) * n  # products around the means
    scale = np.sqrt(np.maximum(np.diag(spread), 0))
    scale[scale == 0] = 1.0
    inner = (spread / np.outer(scale, scale))[1:-1, 1:-1]
    slopes = np.linalg.lstsq(inner, (spread / np.outer(scale, scale))[1:-1, -1], rcond=1e-10)[0] * scale[-1] / scale[1:-1]
    return np.concatenate([[mean[-1] - slopes @ mean[1:-1]], slopes])


def linear_per_unit(df: DataFrame, unit_col: str, order_col: str, features: Sequence[str], target: str, n_splits: int = 5) -> DataFrame:
    """ML17: ``unit, fold, n_train, n_test, coefficients, rmse, r2`` — a linear model for every unit and test block of its own expanding time split,
    and with ``fold`` NULL the one of all rows, scored on them.  One scan of the rows, whatever the number of units.

    Blocks are those of ML5, by the unit's rows in order of ``order_col``.  Models of a fold are solved from
    the sums of the blocks before it.  ``coefficients`` has the constant first; a feature that does not vary gets 0.
    A block without training rows has no coefficients."""
    placed = dense_index(df.select(unit_col, order_col, *features, target), [unit_col], order_col, "_pos")
    number = placed.groupBy(F.col(unit_col).alias("_u")).agg(F.count(F.lit(1)).alias("_n"))
    size = F.expr(f"_n div {n_splits + 1}")
    first = F.col("_n") - n_splits * size
    fold = F.when((size == 0) | (F.col("_pos") < first), -1).otherwise(((F.col("_pos") - first) / size).cast("int"))
    folded = placed.join(number, F.col(unit_col).eqNullSafe(F.col("_u"))).withColumn("fold", fold)
    sums = gram_sums(folded.select(F.col(unit_col).alias("unit"), "fold", *features, target), ["unit", "fold"], features, target)
    sums = written(sums, "grams")
    before = Window.partitionBy("unit", "cell").orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)  # a row a block
    blocks = sums.select("unit", "fold", "cell", F.sum("s").over(before).alias("train"), F.col("s").alias("test")).where("fold >= 0")
    whole = sums.groupBy("unit", "cell").agg(F.sum("s").alias("train")).select("unit", F.lit(None).cast("int").alias("fold"), "cell", "train", F.col("train").alias("test"))
    cells = blocks.unionByName(whole)
    # one array a model, as long as the matrix
    models = cells.groupBy("unit", "fold").agg(F.sort_array(F.collect_list(F.struct("cell", F.coalesce("train", F.lit(0.0)).alias("train"), "test"))).alias("m"))
    width = len(features) + 2

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for unit, fold_no, train, test in zip(pdf.unit, pdf.fold, pdf.train, pdf.test):
                train, test = (np.asarray(m, dtype=np.float64).reshape(width, width) for m in (train, test))
                beta, n = solve(train), test[0, 0]
                rmse = r2 = None
                if beta is not None and n > 0:
                    v = np.concatenate([beta, [-1.0]])  # residual = beta . (1, x) - y
                    sse = max(0.0, float(v @ test @ v))
                    sst = float(test[-1, -1] - test[0, -1] ** 2 / n)
                    rmse, r2 = (sse / n) ** 0.5, None if sst <= 0 else 1 - sse / sst
                out.append((unit, None if pd.isna(fold_no) else int(fold_no), int(train[0, 0]), int(n), None if beta is None else beta.tolist(), rmse, r2))
            yield pd.DataFrame(out, columns=["unit", "fold", "n_train", "n_test", "coefficients", "rmse", "r2"]).astype({"fold": "Int32"})
    unit_kind = df.schema[unit_col].dataType.simpleString()
    return models.select("unit", "fold", "m.train", "m.test").mapInPandas(
        fit, f"unit {unit_kind}, fold int, n_train bigint, n_test bigint, coefficients array<double>, rmse double, r2 double")
