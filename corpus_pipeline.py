"""The corpus pipeline: STAGES over documents, each written as Parquet and read again by the next.

Quality rules drop rejected documents and the lines that many documents of a
host share; SimHash keeps one document of each group of near-duplicates;
decontamination takes benchmark passages out, and documents that are mostly
such; the secret scan blanks secrets; the last stage encodes what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import decontaminate, pieces, quality, secrets, simhash
from sensorloom.session import written
from sensorloom.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that many documents of their host share."""
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest id."""
    return simhash.keep_one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; those that are mostly such go."""
    return decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets blanked."""
    return secrets.redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, ids, n_tokens`` of each remaining document."""
    rows = pieces.encoded(docs.select("doc_id", "lang", "source", "text"), spans=False)
    return rows.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [("quality rules", quality_rules), ("simhash near-dedup", near_duplicates), ("benchmark decontamination", decontamination),
          ("secret scan", secret_scan), ("sentencepiece", encoding)]
ORACLE_SQL = None  # hashes, a forest and a tokenizer: tests/llm/test_pipeline.py holds it against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage but the last is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
