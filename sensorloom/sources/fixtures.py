"""Sensor-shaped inputs derived from the shared test tables.

The reference reads plant historian exports that are not shipped.  Its
operators are exercised here on tables Spark derives from ``/root/testdata``
so that every query's work grows with the data (FIXTURES.md part B):

* F1 hourly wide sensors   — hour bucket × event type, ``avg(value)``
* F2 long sensors          — ``(asset, tag, ts, value)`` straight from events
* F3 10-minute wide grid   — 10-minute buckets on the complete time grid
* F4 unordered duplicates  — events with ``ts`` cut to the hour, ingest order
* F5 tag dictionary        — parameter metadata (small literal table)
* F6 relining campaigns    — first order date of each half-year
* F7 shutdown intervals    — parameter intervals
* F8 cluster labels        — ``hour_of_month % 4`` per hourly row
* F9 metallurgy grades     — arithmetic on lineitem
* F10 regression table     — lineitem features with a constructed target
* F11 multi-sensor vectors — the embeddings table
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions.exprs import bin_left
from sensorloom.operators.reshape import pivot_tags
from sensorloom.sources.tables import table

# The five event types of the test table act as sensor tags.
TAGS = ["click", "error", "purchase", "signup", "view"]
N_ASSETS = 8
AS_OF = datetime(2024, 1, 31, 0, 0, 0)
AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def long_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(asset, tag, ts, value, event_id)``; asset = ``user_id % 8``."""
    return events(spark, sf_dir).select(
        (F.col("user_id") % N_ASSETS).cast("int").alias("asset"),
        F.col("event_type").alias("tag"),
        "ts",
        "value",
        "event_id",
    )


def hourly_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one row per hour that has events, one column per tag (mean value)."""
    ev = events(spark, sf_dir).select(bin_left("ts", 3600).alias("ts"),
                                      F.col("event_type").alias("tag"), "value")
    return pivot_tags(ev, ["ts"], TAGS)


def ten_minute_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10-minute bucket means in long form, only buckets with data."""
    ev = events(spark, sf_dir).select(bin_left("ts", 600).alias("ts"),
                                      F.col("event_type").alias("tag"), "value")
    return ev.groupBy("ts", "tag").agg(F.avg("value").alias("value"))


def ten_minute_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10-minute means, one column per tag, on the complete 10-minute grid."""
    from sensorloom.operators.grid import complete_grid
    ev = events(spark, sf_dir).select(bin_left("ts", 600).alias("ts"),
                                      F.col("event_type").alias("tag"), "value")
    wide = pivot_tags(ev, ["ts"], TAGS)
    return complete_grid(wide, "ts", 600)


def ten_minute_grid_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 in long form ``(tag, ts, pos, value)`` — every grid slot for every tag.

    ``pos`` is the dense grid index ``(t - t0) / 600 s``; windows that count
    rows (lags, rolling frames, NULL runs) order by it.
    """
    from sensorloom.operators.reshape import to_long
    return to_long(ten_minute_wide(spark, sf_dir), ["ts", "pos"], TAGS)


def hourly_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, ts_hour, event_type, value)`` — many rows per hour."""
    return events(spark, sf_dir).select(
        "event_id", bin_left("ts", 3600).alias("ts"), "event_type", "value")


def tag_dictionary(spark: SparkSession) -> DataFrame:
    """the tag dictionary (parameter metadata, one row per tag)."""
    return spark.createDataFrame(TAG_DICT_ROWS, TAG_DICT_SCHEMA)


TAG_DICT_SCHEMA = T.StructType([
    T.StructField("tag", T.StringType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("tag_type", T.StringType(), True),
    T.StructField("data_type", T.StringType(), True),
    T.StructField("unit", T.StringType(), True),
    T.StructField("range_min", T.DoubleType(), True),
    T.StructField("range_max", T.DoubleType(), True),
    T.StructField("on_off_dependencies", T.ArrayType(T.StringType()), True),
    T.StructField("derived", T.BooleanType(), True),
    T.StructField("area", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("op_min", T.DoubleType(), True),
    T.StructField("op_max", T.DoubleType(), True),
    T.StructField("max_delta", T.DoubleType(), True),
    T.StructField("constraint_set", T.StringType(), True),
    T.StructField("target", T.StringType(), True),
    T.StructField("model_feature", T.BooleanType(), True),
])

# The test dictionary (five event tags, two on/off tags that form
# a two-step dependency chain view -> pump_on -> line_on, one derived tag).
TAG_DICT_ROWS = [
    ("click", "Click rate", "control", "numeric", "1/h", 0.0, 100.0, ["pump_on"], False,
     "plant", "click rate", 5.0, 95.0, 10.0, None, None, True),
    ("error", "Error rate", "state", "numeric", "1/h", 0.0, None, [], False,
     "plant", "error rate", None, None, None, None, None, True),
    ("purchase", "Purchase", "output", "numeric", "t/h", None, None, [], False,
     "plant", "purchase value", None, None, None, None, "purchase_target", False),
    ("signup", "Signup", "state", "numeric", "1/h", None, 100.0, [], False,
     "plant", "signup rate", None, None, None, None, "signup_target", True),
    ("view", "View rate", "control", "numeric", "1/h", 0.0, 100.0, ["pump_on"], False,
     "plant", "view rate", 10.0, 90.0, None, "[20, 40, 60, 80]", None, True),
    ("pump_on", "Pump on", "on_off", "boolean", None, 0.0, 1.0, ["line_on"], False,
     "plant", "pump on flag", None, None, None, None, None, False),
    ("line_on", "Line on", "on_off", "boolean", None, 0.0, 1.0, [], False,
     "plant", "line on flag", None, None, None, None, None, False),
    ("click_view_ratio", None, "input", "numeric", None, None, None, [], True,
     "plant", "click per view", None, None, None, None, None, True),
]


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """relining campaign start = first order date of each half-year."""
    o = table(spark, sf_dir, "orders").select("o_orderdate")
    half = (F.year("o_orderdate") * 2 + F.when(F.month("o_orderdate") > 6, 1).otherwise(0))
    return (o.groupBy(half.alias("campaign"))
             .agg(F.min("o_orderdate").alias("start_ts")))


# Three closed shutdown intervals in January 2024; the last one
# starts exactly on a 2-hour bin edge.
SHUTDOWNS = [
    (datetime(2024, 1, 5, 0, 0), datetime(2024, 1, 6, 12, 0)),
    (datetime(2024, 1, 14, 8, 30), datetime(2024, 1, 14, 20, 15)),
    (datetime(2024, 1, 22, 1, 0), datetime(2024, 1, 23, 0, 0)),
]


def shutdowns(spark: SparkSession) -> DataFrame:
    """F7 as a DataFrame ``(start_ts, end_ts)`` (TIMESTAMP_NTZ)."""
    schema = T.StructType([T.StructField("start_ts", T.TimestampNTZType()),
                           T.StructField("end_ts", T.TimestampNTZType())])
    return spark.createDataFrame(SHUTDOWNS, schema)


def cluster_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: ``(ts, cluster)`` for every hourly row: cluster = hour of month mod 4."""
    h = hourly_wide(spark, sf_dir).select("ts")
    hour_of_month = (F.dayofmonth("ts") - 1) * 24 + F.hour("ts")
    return h.select("ts", (hour_of_month % 4).cast("int").alias("cluster"))


def metallurgy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """grades from lineitem (feed, concentrate, tails, tph)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate",
        (F.lit(0.5) + F.lit(15.0) * F.col("l_tax")).alias("feed"),
        (F.lit(20.0) + F.col("l_quantity") / F.lit(5.0)).alias("conc"),
        (F.lit(0.02) + F.lit(3.0) * F.col("l_discount")).alias("tails"),
        F.col("l_quantity").alias("tph"),
    )


def regression_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """features ``l_quantity, l_discount, l_tax`` and a constructed target ``y``."""
    li = table(spark, sf_dir, "lineitem")
    y = (F.lit(3.0) * F.col("l_quantity") - F.lit(40.0) * F.col("l_discount")
         + F.lit(25.0) * F.col("l_tax")
         + ((F.col("l_partkey") % 7) - F.lit(3)).cast("double") / F.lit(10.0))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate",
                     "l_quantity", "l_discount", "l_tax", y.alias("y"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, embedding ARRAY<FLOAT>, label)``."""
    return table(spark, sf_dir, "embeddings")

