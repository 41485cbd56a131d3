"""Parquet scans of the shared test tables.

Scans stay lazy and column-pruned: callers select the columns they need
right after the read so ``ReadSchema`` only lists those, and filters on the
result are pushed into the Parquet reader by Catalyst.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """SRC2: scan one typed table (Parquet replaces the reference's pickles)."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
