"""Projections and column naming (PRJ3–PRJ14).

All of these are one ``select``/``toDF`` each.  Column lists that depend on
the data (all-NULL columns, NULL share) come from **one** aggregate over
every column, never from a Python loop of per-column jobs.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.exprs import to_double
from sensorloom.functions.naming import parse_name


def parse_and_coerce(df: DataFrame, ts_col: str, order_col: str | None = None) -> DataFrame:
    """PRJ3: PRJ1 names, numeric coercion of every other column (``try_cast``,
    NaN → NULL), first of duplicate column names, first row per duplicate
    timestamp (by ``order_col`` ingest order when given, else the row with the
    smallest values)."""
    seen, cols = set(), []
    for c in df.columns:
        n = parse_name(c)
        if n in seen:
            continue
        seen.add(n)
        if c == ts_col or c == order_col:
            cols.append(F.col(f"`{c}`").alias(n))
        else:
            cols.append(to_double(F.col(f"`{c}`").cast("string")).alias(n))
    out = df.select(*cols)
    ts = parse_name(ts_col)
    if order_col is None:
        # no ingest order: the smallest row, so that a retried task keeps the same one
        rest = [c for c in out.columns if c != ts]
        one = out.groupBy(ts).agg(F.min(F.struct(*rest)).alias("_r"))
        return one.select(*[F.col(c) if c == ts else F.col(f"_r.{c}").alias(c) for c in out.columns])
    from sensorloom.operators.filters import dedupe
    return dedupe(out, [ts], parse_name(order_col), keep="first")


def decimal_comma(c: str):
    """PRJ4: ``"12,5"`` → 12.5 (comma decimal repair then coercion)."""
    return to_double(F.regexp_replace(F.col(c).cast("string"), ",", "."))


def select_columns(df: DataFrame, items: Sequence[str] | None = None,
                   regex: str | None = None) -> DataFrame:
    """PRJ5: keep the listed columns, or those matching ``regex`` — exactly one."""
    if (items is None) == (regex is None):
        raise ValueError("give exactly one of items or regex")
    keep = [c for c in df.columns if (c in items if items is not None else re.search(regex, c))]
    return df.select(*keep)


def drop_columns(df: DataFrame, items: Sequence[str] | None = None,
                 regex: str | None = None) -> DataFrame:
    """PRJ6: drop the listed columns or those matching ``regex``."""
    if (items is None) == (regex is None):
        raise ValueError("give exactly one of items or regex")
    gone = [c for c in df.columns if (c in items if items is not None else re.search(regex, c))]
    return df.drop(*gone)


def null_counts(df: DataFrame, cols: Sequence[str]) -> dict:
    """NULL count of every column in one aggregate job."""
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols]).first()
    return row.asDict()


def drop_all_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """PRJ7: drop columns that are entirely NULL."""
    cols = list(cols or df.columns)
    nc = null_counts(df, cols)
    return df.drop(*[c for c in cols if nc[c] == nc["__n"]])


def drop_columns_thres(df: DataFrame, threshold_pct: float = 60.0,
                       cols: Sequence[str] | None = None) -> DataFrame:
    """PRJ8: keep columns whose NULL count ≤ ``round(rows · threshold%)``."""
    cols = list(cols or df.columns)
    nc = null_counts(df, cols)
    limit = round(nc["__n"] * threshold_pct / 100)
    return df.drop(*[c for c in cols if nc[c] > limit])


_ASSIGN = re.compile(r"^\s*([A-Za-z_][A-Za-z0-9_]*)\s*=\s*(.+)$")


def numexpr_eval(df: DataFrame, exprs: Sequence[str]) -> DataFrame:
    """PRJ9: evaluate ``"C = A + B"`` assignments in order; later ones see earlier.

    Expressions are Spark SQL; a non-assignment raises.  Built as one
    ``select`` per expression so each sees the previous columns.
    """
    out = df
    for e in exprs:
        m = _ASSIGN.match(e)
        if not m:
            raise ValueError(f"not an assignment: {e!r}")
        name, rhs = m.group(1), m.group(2)
        out = out.select(*[c for c in out.columns if c != name], F.expr(rhs).alias(name))
    return out


def only_new_columns(df: DataFrame, base_cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """PRJ10: ``df[sorted(columns − base)]`` (plus ``keep`` keys first)."""
    new = sorted(set(df.columns) - set(base_cols) - set(keep))
    return df.select(*keep, *new)


def alias_cycle(df: DataFrame, base: Sequence[str], aliases: Sequence[str]) -> DataFrame:
    """PRJ11: copy base tags into alias columns, cycling through the bases."""
    return df.select("*", *[F.col(base[i % len(base)]).alias(a) for i, a in enumerate(aliases)])


def run_id(*cols: str):
    """PRJ12: deterministic run id ``sha2(ts|asset…)`` — repeatable under task retry
    (a random ``uuid()`` would change when a lost task re-runs)."""
    return F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in cols]), 256)


def with_run_id(df: DataFrame, cols: Sequence[str], name: str = "run_id") -> DataFrame:
    """PRJ12: add the run id as the first column."""
    return df.select(run_id(*cols).alias(name), *df.columns)


# Unit conversions used by the plant features.
M3H_PER_LS = 3.6        # l/s → m³/h
PER_THOUSAND = 1000.0   # kW → MW, g → kg
PER_CENT = 100.0        # % → fraction


def convert(c: str, factor: float, divide: bool = False):
    """PRJ14: unit conversion by a constant factor."""
    return F.col(c) / F.lit(factor) if divide else F.col(c) * F.lit(factor)
