"""Fit on training rows, apply to any rows (§2.14): ``pyspark.ml`` estimators of the column operators.

Each estimator learns a small state — kept columns, bounds, medians, centres — in one or two
aggregate jobs, and its model applies it in one ``select``.  Both hold their settings as ``Param``s, so that they
stand in a ``Pipeline`` beside MLlib stages and are saved and loaded with it.

Columns that were there at fit and are missing later raise; columns that come later are
dropped by :class:`SelectColumns` and pass through the others.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.exprs import nan_to_null, non_negative
from sensorloom.operators import clean, projection
from sensorloom.operators.quantiles import column_quantiles


def check_frame(df) -> DataFrame:
    """Raise unless ``df`` is a DataFrame."""
    if not isinstance(df, DataFrame):
        raise TypeError(f"expected a DataFrame, got {type(df).__name__}")
    return df


class _Saved(DefaultParamsReadable, DefaultParamsWritable):
    """Settings and state as params, written with the stage."""


class _ColumnsParam(Params):
    columns = Param(Params._dummy(), "columns", "the columns to work on; none: all numeric columns", TypeConverters.toListString)

    def _columns_of(self, df: DataFrame) -> list[str]:
        if self.isDefined(self.columns):
            return list(self.getOrDefault(self.columns))
        return [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float", "integer", "long", "short", "byte")
                or f.dataType.typeName().startswith("decimal")]


class _Learned(Model, _Saved):
    """A model whose state is one JSON text."""

    state = Param(Params._dummy(), "state", "what was learned, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, state: str | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @classmethod
    def of(cls, learned) -> "_Learned":
        return cls(state=json.dumps(learned))

    @property
    def learned(self):
        return json.loads(self.getOrDefault(self.state))


class _Fits(Estimator, _Saved):
    def _fit(self, dataset: DataFrame) -> Model:
        return self.learn(check_frame(dataset))

    def learn(self, df: DataFrame) -> Model:
        raise NotImplementedError


# ------------------------------------------------------------------ columns
class KeepModel(_Learned):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return check_frame(dataset).select(*[F.col(f"`{c}`") for c in self.learned])


class DropModel(_Learned):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return check_frame(dataset).drop(*self.learned)


class _Chosen(_Fits):
    """Columns by name or by pattern, exactly one of both."""

    items = Param(Params._dummy(), "items", "column names", TypeConverters.toListString)
    regex = Param(Params._dummy(), "regex", "a pattern found in column names", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, items: Sequence[str] | str | None = None, regex: str | None = None):
        super().__init__()
        given = {k: v for k, v in self._input_kwargs.items() if v is not None}
        if len(given) > 1:
            raise ValueError("give exactly one of items or regex")
        if isinstance(given.get("items"), str):
            given["items"] = [given["items"]]
        self._set(**given)

    def chosen(self, df: DataFrame) -> list[str]:
        if self.isDefined(self.items):
            return [c for c in self.getOrDefault(self.items) if c in df.columns]
        if self.isDefined(self.regex):
            return [c for c in df.columns if re.search(self.getOrDefault(self.regex), c)]
        raise ValueError("give exactly one of items or regex")


class SelectColumns(_Chosen):
    """PRJ5: the chosen columns that are there at fit."""

    def learn(self, df: DataFrame) -> Model:
        return KeepModel.of(self.chosen(df))


class DropColumns(_Chosen):
    """PRJ6."""

    def learn(self, df: DataFrame) -> Model:
        return DropModel.of(self.chosen(df))


class DropAllNull(_Fits):
    """PRJ7: without the columns that are all NULL at fit."""

    def learn(self, df: DataFrame) -> Model:
        counts = projection.null_counts(df, df.columns)
        return DropModel.of([c for c in df.columns if counts[c] == counts["__n"]])


class DropSparse(_Fits):
    """PRJ8: without the columns with more NULLs at fit than ``round(rows * percent / 100)``."""

    percent = Param(Params._dummy(), "percent", "most NULLs of a column, in percent of the rows", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, percent: float = 60.0):
        super().__init__()
        self._setDefault(percent=60.0)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def learn(self, df: DataFrame) -> Model:
        counts = projection.null_counts(df, df.columns)
        limit = round(counts["__n"] * self.getOrDefault(self.percent) / 100)
        return DropModel.of([c for c in df.columns if counts[c] > limit])


# ------------------------------------------------------------------ values
class CutModel(_Learned):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return clean.cut_values_from_dict(check_frame(dataset), self.learned).select(*dataset.columns)


class CutOutliers(_Fits, _ColumnsParam):
    """CLN5: values outside the training rows' own quantiles become NULL."""

    bottom = Param(Params._dummy(), "bottom", "lower quantile", TypeConverters.toFloat)
    top = Param(Params._dummy(), "top", "upper quantile", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, columns: Sequence[str] | None = None, bottom: float = 0.01, top: float = 0.99):
        super().__init__()
        self._setDefault(bottom=0.01, top=0.99)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def learn(self, df: DataFrame) -> Model:
        cols = self._columns_of(df)
        return CutModel.of(column_quantiles(df, cols, [self.getOrDefault(self.bottom), self.getOrDefault(self.top)]))


class CapModel(_Learned):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return clean.clip_and_cap(check_frame(dataset), self.learned).select(*dataset.columns)


class CapOutliers(_Fits, _ColumnsParam):
    """CLN6 with the bounds of the training rows."""

    @keyword_only
    def __init__(self, *, columns: Sequence[str] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def learn(self, df: DataFrame) -> Model:
        return CapModel.of(clean.esp_bounds(df, self._columns_of(df)))


class FillModel(_Learned):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        fills = self.learned
        return check_frame(dataset).select(*[F.col(f"`{c}`") if c not in fills else non_negative(
            F.col(c) if fills[c] is None else F.coalesce(F.col(c), F.lit(fills[c]))).alias(c) for c in dataset.columns])


class FillMedian(_Fits, _ColumnsParam):
    """CLN7 with the training rows' medians, then CLN14."""

    @keyword_only
    def __init__(self, *, columns: Sequence[str] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def learn(self, df: DataFrame) -> Model:
        return FillModel.of({c: v[0] for c, v in column_quantiles(df, self._columns_of(df), [0.5]).items()})


class ScaleModel(_Learned):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        by = self.learned
        return check_frame(dataset).select(*[((F.col(c) - F.lit(by[c][0])) / F.lit(by[c][1])).alias(c) if c in by and by[c][1] else F.col(f"`{c}`")
                                             for c in dataset.columns])


class ScaleColumns(_Fits, _ColumnsParam):
    """CLU1: ``(x - mean) / std`` (ddof 1) or ``(x - median) / IQR`` of the training rows; a column without spread stays."""

    method = Param(Params._dummy(), "method", "standard or robust", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, columns: Sequence[str] | None = None, method: str = "standard"):
        super().__init__()
        if method not in ("standard", "robust"):
            raise ValueError("method must be standard or robust")
        self._setDefault(method="standard")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def learn(self, df: DataFrame) -> Model:
        cols = self._columns_of(df)
        if self.getOrDefault(self.method) == "robust":
            got = column_quantiles(df, cols, [0.25, 0.5, 0.75])
            return ScaleModel.of({c: (m, None if a is None else b - a) for c, (a, m, b) in got.items()})
        r = df.agg(*[F.avg(c).alias(f"c|{c}") for c in cols], *[F.stddev_samp(c).alias(f"s|{c}") for c in cols]).first()
        return ScaleModel.of({c: (r[f"c|{c}"], r[f"s|{c}"]) for c in cols})


def scaling_statistics(before: DataFrame, after: DataFrame, cols: Sequence[str]) -> DataFrame:
    """CLU1: ``stage, variable, n, mean, std, least, q25, median, q75, most`` of columns before and after scaling; one aggregate and one
    quantile job a stage."""
    rows = []
    for stage, df in (("before", before), ("after", after)):
        quartiles = column_quantiles(df, cols, [0.25, 0.5, 0.75])
        kinds = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "least": F.min, "most": F.max}
        r = df.agg(*[f(c).alias(f"{k}|{c}") for k, f in kinds.items() for c in cols]).first()
        for c in cols:
            number = {k: None if r[f"{k}|{c}"] is None else float(r[f"{k}|{c}"]) for k in ("mean", "std", "least", "most")}
            rows.append((stage, c, r[f"n|{c}"], number["mean"], number["std"], number["least"], *quartiles[c], number["most"]))
    return before.sparkSession.createDataFrame(
        rows, "stage string, variable string, n bigint, mean double, std double, least double, q25 double, median double, q75 double, most double")


# ------------------------------------------------------------------ MLlib stages on named columns
class VectorToColumns(Transformer, _Saved):
    """A vector column back into named columns (NaN becomes NULL); the vectors go."""

    source = Param(Params._dummy(), "source", "vector column", TypeConverters.toString)
    names = Param(Params._dummy(), "names", "column names in the vector's order", TypeConverters.toListString)
    gone = Param(Params._dummy(), "gone", "columns to drop", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, source: str | None = None, names: Sequence[str] | None = None, gone: Sequence[str] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = self.getOrDefault(self.names)
        cells = dataset.withColumn("_cells", vector_to_array(self.getOrDefault(self.source)))
        out = cells.withColumns({n: nan_to_null(F.col("_cells")[i]) for i, n in enumerate(names)})
        return out.drop("_cells", *self.getOrDefault(self.gone))


def fit_on_columns(inner: Estimator, df: DataFrame, columns: Sequence[str]) -> PipelineModel:
    """PRJ13: ``inner``, an MLlib estimator from vectors to vectors, fitted on named columns; the model keeps their names.

    Rows with a NULL among them are left out of the fit, and stay NULL in these columns afterwards."""
    columns = list(columns)
    assembler = VectorAssembler(inputCols=columns, outputCol="_in", handleInvalid="keep")
    vectors = assembler.transform(check_frame(df).na.drop(subset=columns).select(*columns))
    model = inner.copy({inner.inputCol: "_in", inner.outputCol: "_out"}).fit(vectors)
    return PipelineModel([assembler, model, VectorToColumns(source="_out", names=columns, gone=["_in", "_out"])])
