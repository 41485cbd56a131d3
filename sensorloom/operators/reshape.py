"""Wide ⇄ long reshaping.

The reference keeps one column per sensor ("wide").  Per-tag statistics
are one ``groupBy("tag")`` over the long layout ``(…keys, tag, value)``,
so screens unpivot once and never loop over columns in Python.

Pivoting back uses one conditional aggregate per tag with an explicit tag
list — a single partial/final hash aggregate (no extra job to discover the
pivot values, no ``PivotFirst`` stage).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_long(df: DataFrame, keys: Sequence[str], tags: Sequence[str],
            tag_col: str = "tag", value_col: str = "value") -> DataFrame:
    """Wide → long with ``unpivot`` (keeps NULL values, one row per key × tag)."""
    cols = [F.col(t).cast("double").alias(t) for t in tags]
    return (df.select(*keys, *cols)
              .unpivot(list(keys), list(tags), tag_col, value_col))


def pivot_tags(df: DataFrame, keys: Sequence[str], tags: Sequence[str],
               tag_col: str = "tag", value_col: str = "value", agg: str = "avg",
               prefix: str = "") -> DataFrame:
    """Long → wide: ``agg(value) FILTER (WHERE tag = t)`` for each listed tag."""
    fn = {"avg": F.avg, "mean": F.avg, "sum": F.sum, "count": F.count,
          "min": F.min, "max": F.max, "first": lambda c: F.first(c, ignorenulls=True)}[agg]
    aggs = [fn(F.when(F.col(tag_col) == F.lit(t), F.col(value_col))).alias(prefix + t)
            for t in tags]
    return df.groupBy(*keys).agg(*aggs)
