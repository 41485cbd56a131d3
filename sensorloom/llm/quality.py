"""Quality rules with cross-document line frequency (operator 1).

One Arrow pass per document gives word, symbol and repeat counts and the hashes
of its normalised lines.  Lines are then counted per host over distinct documents
(copies of a page under ids of their own are documents each), first by line and
document and then by line, with a partial count in every task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.session import written
from sensorloom.sources.tables import table

BLANKS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
DIGITS = re.compile(r"\d+")


@dataclass(frozen=True)
class Limits:
    """``min_words`` and ``repeat_share`` are the base rules.  A line is removed
    in a host if more than ``min_docs`` of its distinct documents hold it, and
    more than ``doc_share`` of them where a share is given; a document is depleted if removal takes more
    than ``depleted_share`` of its words."""

    min_words: int = 20
    repeat_percent: int = 30
    window: int = 8
    min_docs: int = 10
    doc_share: float = 0.0
    depleted_share: float = 0.5


def repeat_words(words: list[bytes], size: int) -> int:
    """Words inside ``size``-word windows that occur twice or more in the text.

    Window equality is exact: windows of 2, 4, 8, … words get ranks from the
    ranks of their halves."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    rank = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    have = 1
    while have < size:
        step = min(have, size - have)
        pair = rank[: len(rank) - step] * (rank.max() + 1) + rank[step:]
        rank = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        have += step
        if rank.max() + 1 == len(rank):  # all differ, and longer windows will too
            return 0
    twice = (np.bincount(rank) > 1)[rank]
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.nonzero(twice)[0]
    edge[at] += 1
    edge[at + size] -= 1
    return int((np.cumsum(edge) > 0).sum())


def normal_line(line: str) -> bytes:
    """Lower case, single blanks, digit runs as 0; lines without a word give b''."""
    return b" ".join(DIGITS.sub("0", line.lower()).encode("utf-8").split())


def line_hash(line: bytes) -> int:
    return xxhash.xxh3_64_intdigest(line) - (1 << 63)


def text_facts(text: str | None, window: int = 8) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, line hashes, words per line)."""
    text = text or ""
    words = text.encode("utf-8").split()
    seen: set[str] = set()
    dup, hashes, sizes = 0, [], []
    for line in text.split("\n"):
        size = len(line.encode("utf-8").split())
        if size:
            dup += line in seen
            seen.add(line)
            hashes.append(line_hash(normal_line(line)))
            sizes.append(size)
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), dup,
            repeat_words(words, window), hashes, sizes)


FACTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lines array<long>, sizes array<int>"


def facts(docs: DataFrame, doc_id: str, text: str, host: str, window: int) -> DataFrame:
    """``doc_id, host, text_hash`` and the facts of each row; host as a hash, null being a host of its own."""
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), _host(host).alias("host"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    names = [c.split()[0] for c in FACTS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = pd.DataFrame([text_facts(t, window) for t in pdf.text], columns=names)
            yield pd.concat([pdf[["doc_id", "host", "text_hash"]], got], axis=1)

    kind = docs.schema[doc_id].dataType.simpleString()
    # the id travels as text: pandas would turn a column with nulls into floats
    out = rows.mapInPandas(run, f"doc_id string, host long, text_hash long, {FACTS}")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def _host(host: str):
    return F.xxhash64(F.col(host).isNull(), F.col(host))


def frequent_lines(rows: DataFrame, limits: Limits) -> DataFrame:
    """``host, line, keeper_id, keeper_text``: lines above the limits, and the one document that keeps each: that of smallest id, of one id
    that of smallest text hash (null ids last).

    A document is a doc_id of the host, or a distinct text where the id is null."""
    texts = rows.groupBy("host", "text_hash", "doc_id").agg(F.first(F.array_distinct("lines")).alias("lines"))
    none = F.col("doc_id").isNull()
    texts = written(texts.withColumn("doc", F.struct("doc_id", F.when(none, F.col("text_hash")).alias("text"))), "texts")
    lines = texts.select("host", F.explode("lines").alias("line"), "doc", F.struct(none.alias("none"), "doc_id", "text_hash").alias("k"))
    lines = lines.groupBy("host", "line", "doc").agg(F.min("k").alias("k")).groupBy("host", "line").agg(F.count("*").alias("n"), F.min("k").alias("k"))
    lines = lines.where(F.col("n") > limits.min_docs)
    sizes = texts.select("host", "doc").distinct().groupBy("host").agg(F.count("*").alias("n_docs"))
    lines = lines.join(sizes, "host").where(F.col("n") > F.col("n_docs") * F.lit(limits.doc_share))
    return written(lines.select("host", "line", F.col("k.doc_id").alias("keeper_id"), F.col("k.text_hash").alias("keeper_text")), "frequent")


def judged(docs: DataFrame, limits: Limits = Limits(), doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Facts and verdict per row: ``doc_id, host, text_hash, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, n_removed_lines, n_removed_words, removed, kept``.

    ``removed`` lists the line hashes to take out of the text.  A line above the
    limits stays in one document of its host, the first, so no line vanishes from
    the corpus; copies of that document under other ids lose it like all others.  Null and empty texts have no words and fail
    the base rule; a null host is a host; repeated rows are one text.  Columns
    beside the three named are not read."""
    rows = written(facts(docs, doc_id, text, host, limits.window), "facts")
    frequent = frequent_lines(rows, limits)
    hit = rows.select("host", "text_hash", F.explode(F.arrays_zip("lines", "sizes")).alias("l"), "doc_id")
    hit = hit.select("host", "text_hash", "doc_id", F.col("l.lines").alias("line"), F.col("l.sizes").cast("long").alias("words"))
    hit = hit.join(frequent, ["host", "line"]).where("not (doc_id <=> keeper_id and text_hash = keeper_text)")
    # repeated rows and copies hold the same lines: count each text's lines by one of its rows
    hit = hit.groupBy("host", "text_hash", "doc_id").agg(F.count("*").alias("lines"), F.sum("words").alias("words"),
                                                        F.collect_set("line").alias("removed"))
    copies = rows.groupBy("host", "text_hash", "doc_id").agg(F.count("*").alias("copies"))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"h.{c}")) for c in ("host", "text_hash", "doc_id")]
    hit = hit.alias("h").join(copies.alias("r"), same).select("h.*", "r.copies")
    hit = hit.select(*[F.col(c).alias(f"hit_{c}") for c in ("host", "text_hash", "doc_id")], "removed",
                     (F.col("lines") / F.col("copies")).cast("long").alias("n_removed_lines"),
                     (F.col("words") / F.col("copies")).cast("long").alias("n_removed_words"))
    hit = written(hit, "removed")
    out = rows.join(hit, [F.col(c).eqNullSafe(F.col(f"hit_{c}")) for c in ("host", "text_hash", "doc_id")], "left")
    failed = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words"))
    zero = F.lit(0).cast("long")
    out = out.withColumns({"base_failed": failed, "n_removed_lines": F.coalesce("n_removed_lines", zero),
                           "n_removed_words": F.coalesce("n_removed_words", zero)})
    kept = ~F.col("base_failed") & (F.col("n_removed_words") <= F.col("n_words") * F.lit(limits.depleted_share))
    return out.withColumn("kept", kept).drop("lines", "sizes", *[f"hit_{c}" for c in ("host", "text_hash", "doc_id")])


def clean(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``documents`` without rejected rows and without the lines above the limits; ``n_chars`` follows changed texts.

    Null and empty texts fail the base rule and go; repeated rows share one verdict; an empty table gives an empty result."""
    verdict = judged(docs, limits).groupBy("doc_id", "host", "text_hash").agg(F.first("kept").alias("kept"), F.first("removed").alias("removed"))
    verdict = written(verdict.where("kept").select(F.col("doc_id").alias("__sl_id"), F.col("host").alias("__sl_host"),
                                                   F.col("text_hash").alias("__sl_hash"), F.col("removed").alias("__sl_removed")), "verdicts")
    rows = docs.join(verdict, docs["doc_id"].eqNullSafe(F.col("__sl_id")) & (_host("source") == F.col("__sl_host"))
                     & (F.xxhash64(docs["text"]) == F.col("__sl_hash")))

    @F.pandas_udf("string")
    def without(texts: pd.Series, removed: pd.Series) -> pd.Series:
        out = []
        for t, lines in zip(texts, removed):
            gone = set(lines)
            out.append("\n".join(x for x in t.split("\n") if not ((k := normal_line(x)) and line_hash(k) in gone)))
        return pd.Series(out, dtype=object)

    same = rows.where("__sl_removed IS NULL").select(docs.columns)
    changed = rows.where("__sl_removed IS NOT NULL").withColumn("text", without("text", "__sl_removed"))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return same.unionByName(changed.select(docs.columns))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: counts, base rule and verdict of every document."""
    return judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_lines", "n_removed_words")
