"""Session helpers.

Production code never builds its own session: every operator takes the
DataFrames it works on.  This module is for tests, the bench and the CLI
entry points only.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[SparkContext, str] = {}


def get_spark(cpus: int | str = "*", shuffle_partitions: int = 8,
              app: str = "sensorloom") -> SparkSession:
    """Local session with the settings the tests and the bench rely on."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SENSORLOOM_DRIVER_MEM", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder and register it.

    The folder is what ``spark.checkpoint.dir`` names (HDFS, S3, a shared
    mount, …).  Only a single-machine ``local[...]`` session, as in tests, may
    leave it unset and then gets a scratch folder; on a cluster an unset
    folder is an error, because executors could not read each other's files.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if spark.sparkContext not in _LOCAL_DIRS:
        _LOCAL_DIRS[spark.sparkContext] = tempfile.mkdtemp(prefix="sensorloom-ckpt-")
        spark.sparkContext.setCheckpointDir(_LOCAL_DIRS[spark.sparkContext])
    return _LOCAL_DIRS[spark.sparkContext]


@contextmanager
def settings(spark: SparkSession, **conf: str):
    """Runtime settings (``__`` for ``.``) that hold inside the block only."""
    keys = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; no two calls return the same."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sensorloom-{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back.

    This cuts the lineage: a lost executor costs the tasks that were running,
    never a finished step.  The write's shuffle files go when it ends, so a job
    of many steps holds one step's shuffle on disk, not the sum."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by :func:`written` that nothing reads any more, so that long jobs hold less of the shared folder."""
    for t in tables:
        spark = t.sparkSession
        folders = {f.rpartition("/")[0] for f in t.inputFiles()}
        for folder in folders:
            if "/sensorloom-" not in folder:
                raise ValueError(f"{folder} is not a scratch table")
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
