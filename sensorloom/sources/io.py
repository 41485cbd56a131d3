"""Scans and sinks (SRC1, SRC3, SRC4, SNK1–SNK7).

Every reader declares its schema (no inference pass over the data) and
every writer is a distributed ``DataFrameWriter`` — nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_sensor_csv(spark: SparkSession, path: str, tags: Sequence[str], ts_col: str = "Fecha",
                    sep: str = ",", ts_format: str = "dd/MM/yyyy HH:mm",
                    encoding: str = "ISO-8859-1") -> DataFrame:
    """SRC1: historian CSV export — separator, latin-1, day-first dates; tag
    columns read as text and coerced with ``try_cast`` (bad cells → NULL)."""
    schema = T.StructType([T.StructField(ts_col, T.StringType())]
                          + [T.StructField(t, T.StringType()) for t in tags])
    raw = (spark.read.schema(schema).option("header", True).option("sep", sep)
           .option("encoding", encoding).csv(path))
    return raw.select(F.try_to_timestamp(F.col(ts_col), F.lit(ts_format)).cast("timestamp_ntz").alias(ts_col),
                      *[F.expr(f"try_cast(`{t}` AS DOUBLE)").alias(t) for t in tags])


def read_tag_dictionary_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC3: dictionary CSV; ``on_off_dependencies`` text → ``ARRAY<STRING>``."""
    from sensorloom.operators.tags import parse_dependencies
    d = spark.read.option("header", True).csv(path)
    cols = []
    for c in d.columns:
        if c in ("range_min", "range_max", "op_min", "op_max", "max_delta"):
            cols.append(F.expr(f"try_cast(`{c}` AS DOUBLE)").alias(c))
        elif c == "on_off_dependencies":
            cols.append(parse_dependencies(F.col(c)).alias(c))
        elif c == "derived":
            cols.append(F.lower(F.col(c)).isin("true", "1", "1.0").alias(c))
        else:
            cols.append(F.col(c))
    return d.select(*cols)


def read_tag_dictionary_json(spark: SparkSession, path: str, value_schema: str) -> DataFrame:
    """SRC3: JSON ``orient=index`` (``{tag: {...}}``) → one row per tag."""
    txt = spark.read.text(path, wholetext=True)
    m = txt.select(F.from_json("value", f"map<string, struct<{value_schema}>>").alias("m"))
    return m.select(F.explode("m").alias("tag", "r")).select("tag", "r.*")


# Date patterns tried, in order, for mixed-format campaign dates.
CAMPAIGN_DATE_FORMATS = ["yyyy-MM-dd", "dd-MM-yyyy", "dd/MM/yyyy", "yyyy/MM/dd", "dd-MM-yy"]


def read_campaigns(spark: SparkSession, path: str, machines: Sequence[str],
                   name_col: str = "Campana") -> DataFrame:
    """SRC4: one date column per machine → long ``(campaign, machine, start_ts)``
    with ``unpivot`` and the first pattern that parses (gaps → dropped)."""
    d = spark.read.option("header", True).csv(path)
    long = d.unpivot([name_col], list(machines), "machine", "date_text")
    parsed = F.coalesce(*[F.try_to_timestamp(F.col("date_text"), F.lit(f)) for f in CAMPAIGN_DATE_FORMATS])
    return long.select(F.col(name_col).alias("campaign"), "machine",
                       parsed.cast("timestamp_ntz").alias("start_ts")).where("start_ts IS NOT NULL")


def parse_props(df: DataFrame, col: str = "props", schema: str = "k long") -> DataFrame:
    """JSON text cells → struct columns (``from_json``)."""
    return df.withColumn("_p", F.from_json(F.col(col), schema)).select("*", "_p.*").drop("_p")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "overwrite") -> None:
    """SNK1/SNK4: Parquet or CSV, optionally partitioned (e.g. by date or cluster)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_json_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK2: recommendations as JSON records (struct/map columns kept nested)."""
    df.write.mode(mode).json(path)


def flatten_two_level(df: DataFrame, sep: str = "__") -> DataFrame:
    """SNK3: two-level (struct) columns → flat ``outer__inner`` names for CSV."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            cols += [F.col(f"`{f.name}`.`{s.name}`").alias(f"{f.name}{sep}{s.name}") for s in f.dataType.fields]
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def save_model(model, path: str) -> None:
    """SNK5: persist an MLlib ``PipelineModel``."""
    model.write().overwrite().save(path)


def keep(df: DataFrame, name: str) -> DataFrame:
    """SNK6: keep a result for later steps (cached + temp view)."""
    df = df.persist()
    df.createOrReplaceTempView(name)
    return df
