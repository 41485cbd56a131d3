"""Registry and shared pieces of the registered queries.

Each query is ``fn(spark, sf_dir) -> DataFrame``; most have a DuckDB SQL
oracle computing the same rows on the same Parquet tables.  Output rules
shared by both sides: doubles rounded to 6 digits, timestamps as
TIMESTAMP_NTZ (DuckDB ``TIMESTAMP``), every computed column aliased.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.sources.fixtures import TAGS

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query under ``name`` with an optional DuckDB oracle."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def round_digits(c, digits: int = 6):
    """``round(x · 10^d + 0.001) / 10^d`` in both engines.

    The scaled product is the same IEEE double in Spark and DuckDB, so both
    round it alike (rounding ``x`` directly differs: Spark rounds the decimal
    text, DuckDB the binary value).  The 0.001 offset moves the rounding
    boundary off exact decimal ties such as ``…0.5e-6``, where a last-bit
    difference from a different summation order would flip the digit."""
    k = float(10 ** digits)
    return F.round(c * F.lit(k) + F.lit(0.001)) / F.lit(k)


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles/floats and make timestamps zone-free for comparison."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = round_digits(c.cast("double"), digits)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# --------------------------------------------------------------------------
# SQL fragments for the DuckDB oracles
# --------------------------------------------------------------------------

def sql_r(expr: str, digits: int = 6) -> str:
    k = 10 ** digits
    return f"(round(CAST({expr} AS DOUBLE) * CAST({k} AS DOUBLE) + CAST(0.001 AS DOUBLE)) / CAST({k} AS DOUBLE))"


def sql_bin_right(ts: str, rule_s: int, offset_s: int) -> str:
    r, o = rule_s * 1_000_000, offset_s * 1_000_000
    return f"make_timestamp(CAST(ceil((epoch_us({ts}) - {o}) / {r}) AS BIGINT) * {r} + {o})"


def sql_bin_left(ts: str, rule_s: int, offset_s: int = 0) -> str:
    r, o = rule_s * 1_000_000, offset_s * 1_000_000
    return f"make_timestamp(CAST(floor((epoch_us({ts}) - {o}) / {r}) AS BIGINT) * {r} + {o})"


def sql_pivot(source: str, key_expr: str, agg: str = "avg", tags=TAGS,
              tag_col: str = "event_type", value_col: str = "value", prefix: str = "") -> str:
    cols = ", ".join(f"{agg}({value_col}) FILTER (WHERE {tag_col} = '{t}') AS {prefix}{t}"
                     for t in tags)
    return f"SELECT {key_expr} AS ts, {cols} FROM {source} GROUP BY 1"


# hourly wide sensors
SQL_HOURLY = sql_pivot("events", sql_bin_left("ts", 3600))

# 10-minute wide sensors on the complete grid, with the dense position
SQL_TEN_MIN = f"""
ten_raw AS ({sql_pivot("events", sql_bin_left("ts", 600))}),
ten_grid AS (
  SELECT unnest(generate_series((SELECT min(ts) FROM ten_raw), (SELECT max(ts) FROM ten_raw),
                                INTERVAL 10 MINUTE)) AS ts),
ten AS (
  SELECT g.ts,
         CAST((epoch_us(g.ts) - (SELECT epoch_us(min(ts)) FROM ten_raw)) / 600000000 AS BIGINT) AS pos,
         {", ".join("r." + t for t in TAGS)}
  FROM ten_grid g LEFT JOIN ten_raw r USING (ts))
"""

# F3 long form
SQL_TEN_LONG = SQL_TEN_MIN + """,
ten_long AS (
  SELECT ts, pos, tag, value
  FROM ten UNPIVOT INCLUDE NULLS (value FOR tag IN (""" + ", ".join(TAGS) + """)))
"""
