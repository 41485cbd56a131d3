"""Stupid-backoff language-model scores as joins (operator 9).

With c the counts, T the training tokens and a the backoff weight, a word's score
is c(h w) / c(h) for the longest history h whose n-gram was seen, times a for
each shorter step.  An n-gram seen at order k was seen at every lower order, so
the log score of a document is a sum of one number per seen n-gram:

    d_1 = log c(w) - log oov          d_k = s_k(h w) - s_{k-1}(h' w) - log a

where s_k = log c(h w) - log c(h) and h' is h without its first word; each word adds
log(oov / T) and (orders open to it - 1) log a besides.  So a document's n-grams
are exploded, joined by hash to tables (n-gram hash, d) and summed; no position
is ever grouped.  Each order is a step of its own that ends in sums per document.

Where the documents are their own training corpus, a document is scored under the counts of
the documents of the other half (:func:`held_out_scores`): texts fall into two halves by their
digest, so a document never counts for its own score, nor do its copies, and what only it
says does back off.  There the same joins run on packed columns:

1. Equal texts are one with a number of copies.  Blocks of texts of one half become arrays of word numbers.
2. A block's distinct n-grams, hashed by array arithmetic and counted, are dealt by ranges of the hash.
3. A range of the count table adds up the blocks' counts for both halves and answers each block with the
   other half's count of every n-gram it sent, in the order sent.
4. A block puts the answers back to its words, takes the longest history seen, and sums per text.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm.decontaminate import words_of
from sensorloom.session import discard, settings, written
from sensorloom.sources.tables import table

ORDER, WEIGHT, OOV = 3, 0.4, 0.5


def _grams(k: int) -> Column:
    """``array<struct<key, prefix, suffix>>`` of the k-grams of ``h``, the array of word hashes; keys of one word are its hash."""
    n = F.size("h")
    if k == 1:
        return F.transform("h", lambda x: F.struct(x.alias("key")))
    both = F.zip_with(F.slice("h", 1, n - 1), F.slice("h", 2, n - 1), lambda a, b: F.struct(
        F.xxhash64(a, b).alias("key"), a.alias("prefix"), b.alias("suffix")))
    for _ in range(k - 2):  # a longer key joins the keys of two shorter n-grams that overlap
        both = F.zip_with(F.slice(both, 1, F.size(both) - 1), F.slice(both, 2, F.size(both) - 1), lambda a, b: F.struct(
            F.xxhash64(a["key"], b["key"]).alias("key"), a["key"].alias("prefix"), b["key"].alias("suffix")))
    return F.when(n >= k, both)


def hashed_words(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and ``h``, the hashes of the words of ``text``."""
    # explode of one element keeps the words from being computed again for each n-gram
    return docs.select(*keep, F.explode(F.array(F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)))).alias("h"))


def gram_tables(train: DataFrame, order: int = ORDER, weight: float = WEIGHT, oov: float = OOV) -> tuple[list[DataFrame], int]:
    """(tables of ``key, d`` for the orders 1 to ``order``, training tokens) of ``train(text)``."""
    words = written(hashed_words(train), "train")
    total = words.agg(F.coalesce(F.sum(F.size("h")), F.lit(0))).first()[0]
    out, below = [], None
    for k in range(1, order + 1):
        names = ["key"] if k == 1 else ["key", "prefix", "suffix"]
        grams = words.select(F.inline(_grams(k))).groupBy(*names).agg(F.count("*").alias("c"))
        if k == 1:
            below = written(grams.select("key", F.log("c").alias("lc"), (F.log("c") - math.log(max(total, 1))).alias("s")), "grams")
            out.append(below.select("key", (F.col("lc") - math.log(oov)).alias("d")))
            continue
        prefix = below.select(F.col("key").alias("prefix"), F.col("lc").alias("lp"))
        suffix = below.select(F.col("key").alias("suffix"), F.col("s").alias("ls"))
        counted = written(grams.join(prefix, "prefix").select("key", "suffix", F.log("c").alias("lc"), (F.log("c") - F.col("lp")).alias("s")), "counted")
        below = written(counted.join(suffix, "suffix").select("key", "lc", "s", (F.col("s") - F.col("ls") - math.log(weight)).alias("d")), "grams")
        discard(counted)
        out.append(below.select("key", "d"))
    discard(words)
    return out, int(total)


# ------------------------------------------------------------------ under the counts of the other half
#: bytes of text in a block, and distinct n-grams of all blocks in a range of the count table, both about
BLOCK_BYTES, RANGE_GRAMS = 4 << 20, 1 << 21
#: A-Z become a-z, what stands between words becomes a blank; bytes of other characters stay
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def tokenized(texts: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each distinct word, number of each word of the texts in a row, words of each text)."""
    numbers: dict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    parts, sizes = [], []
    for t in texts:
        words = t.encode("utf-8").translate(_LETTERS).split(b" ")
        ids = np.array([numbers[w] for w in words if w], dtype=np.uint32)
        parts.append(ids)
        sizes.append(len(ids))
    h = xxhash.xxh3_64_intdigest
    vocabulary = np.fromiter((h(w) for w in numbers), dtype="<u8", count=len(numbers))
    return vocabulary, np.concatenate(parts) if parts else np.zeros(0, np.uint32), np.array(sizes, np.int64)


def grams(words: np.ndarray, sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place of its last word) of every k-gram that lies in one text."""
    text = np.repeat(np.arange(len(sizes)), sizes)
    last = np.arange(k - 1, len(words))
    key = words
    for _ in range(k - 1):  # a longer n-gram from two shorter ones that overlap
        key = _mix(key[:-1] * _ODD + key[1:])
    inside = text[last] == text[last - k + 1]
    return (key if k > 1 else _mix(key))[inside], last[inside]


def _whole(counts: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs."""
    top = int(counts.max()) if len(counts) else 0
    return counts.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8").tobytes()


def _numbers(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(packed, f"<u{len(packed) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def blocks_of(docs: DataFrame) -> DataFrame:
    """``half, block`` and the packed ``vocabulary, ids, sizes, copies, tids`` of the distinct texts of ``docs(tid, text)``; written."""
    volume = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    number = max(1, math.ceil(volume / 2 / BLOCK_BYTES))
    # partial aggregates make one row a task of a text that many documents have
    texts = docs.groupBy("tid").agg(F.min("text").alias("text"), F.count("*").alias("copies"))
    half = F.pmod(F.conv(F.substring("tid", 1, 1), 16, 10).cast("int"), F.lit(2))
    dealt = texts.select(half.alias("half"), F.pmod(F.xxhash64("tid"), F.lit(number)).cast("int").alias("block"), "tid", "copies", "text")

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        vocabulary, ids, sizes = tokenized(pdf.text)
        return pd.DataFrame({"half": pdf.half[:1], "block": pdf.block[:1], "n_words": [int((sizes * pdf.copies.to_numpy()).sum())], "vocabulary": [vocabulary.tobytes()],
                             "ids": [_whole(ids)], "sizes": [sizes.tobytes()], "copies": [pdf.copies.to_numpy("<i8").tobytes()], "tids": [list(pdf.tid)]})
    kind = "half int, block int, n_words long, vocabulary binary, ids binary, sizes binary, copies binary, tids array<string>"
    return written(dealt.groupBy("half", "block").applyInPandas(pack, kind), "blocks")


def _unpacked(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes in a row, words of each text, copies of each text) of a block."""
    sizes = np.frombuffer(row.sizes, "<i8")
    return np.frombuffer(row.vocabulary, "<u8")[_numbers(row.ids, int(sizes.sum()))], sizes, np.frombuffer(row.copies, "<i8")


def other_half(blocks: DataFrame, orders: list[int], bits: int) -> DataFrame:
    """``half, block, k, part, n, counts``: for the sorted distinct k-grams of a block, cut into 2 ** ``bits`` ranges of the hash,
    how often each stands in the texts of the other half; written."""
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                words, sizes, copies = _unpacked(row)
                for k in orders:
                    key, last = grams(words, sizes, k)
                    if (copies == 1).all():
                        key, n = np.unique(key, return_counts=True)
                    else:
                        key, at = np.unique(key, return_inverse=True)
                        n = np.zeros(len(key), np.int64)
                        np.add.at(n, at, np.repeat(copies, sizes)[last])
                    cut = np.searchsorted(key >> np.uint64(64 - bits) if bits else np.zeros(len(key), np.uint64), np.arange((1 << bits) + 1, dtype=np.uint64))
                    some = np.nonzero(np.diff(cut))[0]
                    yield pd.DataFrame({"k": k, "part": some.astype("<i4"), "half": row.half, "block": row.block,
                                        "keys": [key[cut[p]: cut[p + 1]].tobytes() for p in some], "n": [_whole(n[cut[p]: cut[p + 1]]) for p in some]})

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(x, "<u8") for x in pdf["keys"]]
        sizes = np.array([len(x) for x in keys])
        n = np.concatenate([_numbers(x, len(y)) for x, y in zip(pdf.n, keys)])
        half = np.repeat(pdf.half.to_numpy(), sizes)
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        both = np.zeros((2, at.max() + 1), np.int64)
        np.add.at(both, (half, at), n)
        found = both[1 - half, at]
        end = np.cumsum(sizes)
        return pd.DataFrame({"half": pdf.half, "block": pdf.block, "k": pdf.k, "part": pdf.part, "n": sizes,
                             "counts": [_whole(found[e - m: e]) for e, m in zip(end, sizes)]})
    kind = "k int, part int, half int, block int, keys binary, n binary"
    sent = blocks.select("half", "block", "vocabulary", "ids", "sizes", "copies").mapInPandas(send, kind)
    answers = sent.groupBy("k", "part").applyInPandas(answer, "half int, block int, k int, part int, n long, counts binary")
    with settings(blocks.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="4"):  # a row is a block
        return written(answers, "answers")


def held_out_scores(docs: DataFrame, order: int = ORDER, weight: float = WEIGHT, oov: float = OOV) -> DataFrame:
    """``tid, n_words, n_seen, log_score`` of the distinct texts of ``docs(tid, text)``, ``tid`` the text's MD5 digest in hex:
    each under the n-gram counts of all texts (with their copies) of the other half, told apart by the digest's first digit."""
    blocks = blocks_of(docs)
    totals = {r.half: r.n for r in blocks.groupBy("half").agg(F.sum("n_words").alias("n")).collect()}
    bits = max(0, math.ceil(math.log2(max(1, sum(totals.values())) / RANGE_GRAMS)))
    # the highest order makes the most n-grams and goes alone: less is on disk at a time
    answers = other_half(blocks, [order], bits)
    if order > 1:
        answers = answers.unionByName(other_half(blocks, list(range(1, order)), bits))

    def score(_, mine: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        row = next(mine.itertuples(index=False))
        words, sizes, _ = _unpacked(row)
        total = totals.get(1 - row.half, 0)
        c = {}
        got = got.sort_values(["k", "part"])
        for k in range(1, order + 1):
            key, last = grams(words, sizes, k)
            _, at = np.unique(key, return_inverse=True)
            parts = got[got.k == k]
            counts = [_numbers(x, n) for x, n in zip(parts.counts, parts.n)]
            c[k] = np.zeros(len(words), np.int64)
            if counts:
                c[k][last] = np.concatenate(counts)[at]
        place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        level = np.zeros(len(words), np.int64)  # the longest order seen
        for k in range(1, order + 1):
            level[c[k] > 0] = k
        with np.errstate(divide="ignore"):
            s = np.full(len(words), math.log(oov) - math.log(max(total, 1)))
            for k in range(1, order + 1):
                below = np.log(c[k - 1][:-1]) if k > 1 else math.log(max(total, 1))
                here = np.log(c[k])
                if k > 1:
                    here[1:] -= below
                else:
                    here -= below
                s = np.where(level == k, here, s)
        s += (np.minimum(place + 1, order) - np.maximum(level, 1)) * math.log(weight)
        text = np.repeat(np.arange(len(sizes)), sizes)
        log_score = np.bincount(text, s, len(sizes)) if total else np.full(len(sizes), None, dtype=object)
        seen = np.bincount(text[level == order], minlength=len(sizes))
        return pd.DataFrame({"tid": list(row.tids), "n_words": sizes, "n_seen": seen, "log_score": log_score})
    both = blocks.groupBy("half", "block").cogroup(answers.groupBy("half", "block"))
    return both.applyInPandas(score, "tid string, n_words long, n_seen long, log_score double")


def scores(docs: DataFrame, train: DataFrame | None = None, order: int = ORDER, weight: float = WEIGHT, oov: float = OOV,
           doc_id: str = "doc_id", text: str = "text", slices: int = 2) -> DataFrame:
    """``doc_id, n_words, n_seen, log_score`` per row of ``docs`` under the n-gram counts of ``train(text)``, or, without it, of the other half of ``docs``.

    ``n_seen`` counts words whose n-gram of the highest order was seen;
    ``log_score`` is the natural log of the product of the words' scores, 0
    without words (null and empty texts), and null if there are no training words.
    With ``train``, the n-grams of an order are joined in ``slices`` parts by hash, one after the
    other: the shuffle of one part is all the disk that is needed at a time.
    Words are as in decontamination.  Repeated rows get equal results; a null
    doc_id is a row like others; other columns are not read.  An empty table gives an empty result."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if train is None:
        docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tid", F.md5("text"))
        rows = written(held_out_scores(docs.select("tid", "text"), order, weight, oov), "scores")
        return docs.select("doc_id", "tid").join(rows, "tid").select("doc_id", "n_words", "n_seen", "log_score")
    tables, total = gram_tables(train, order, weight, oov)
    words = docs.select(F.xxhash64("doc_id", "text").alias("doc"), "text")
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("doc"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    copies = rows.groupBy("doc").agg(F.count("*").alias("copies")).where("copies > 1")
    sums = None
    for k, grams in enumerate(tables, 1):
        for part in range(slices):
            own = F.pmod(F.xxhash64("key", F.lit(k)), F.lit(slices)) == part
            exploded = hashed_words(words, "doc").select("doc", F.explode(_grams(k)["key"]).alias("key")).where(own)
            one = exploded.join(grams.where(own), "key").groupBy("doc").agg(F.sum("d").alias("d"), F.count("*").alias("n"))
            one = written(one.withColumn("k", F.lit(k)), f"order{k}-{part}")
            sums = one if sums is None else sums.unionByName(one)
        discard(grams)
    sums = sums.groupBy("doc").agg(F.sum("d").alias("d"), F.sum(F.when(F.col("k") == order, F.col("n"))).alias("n"))
    out = rows.join(sums, "doc", "left").join(copies, "doc", "left")
    once = F.coalesce("copies", F.lit(1))
    n = F.col("n_words")
    open_orders = F.aggregate(F.sequence(F.lit(1), F.lit(order - 1)), F.lit(0).cast("long"), lambda s, j: s + F.greatest(n - j, F.lit(0))) if order > 1 else F.lit(0)
    log_score = F.coalesce("d", F.lit(0.0)) / once + n * (math.log(oov) - math.log(max(total, 1))) + open_orders * math.log(weight)
    return out.select("doc_id", "n_words", F.coalesce((F.col("n") / once).cast("long"), F.lit(0).cast("long")).alias("n_seen"),
                      F.when(F.lit(total > 0), log_score).alias("log_score"))


def good_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A training corpus to pass as ``train``: documents labelled of good quality and not toxic."""
    labels = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id").distinct()
    return table(spark, sf_dir, "documents").select("doc_id", "text").join(labels, "doc_id", "left_semi").select("text")


def op9_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: trigram stupid-backoff score of every document under the counts of all documents of the other half."""
    rows = scores(table(spark, sf_dir, "documents"))
    mean = F.when(F.col("n_words") > 0, F.round(F.col("log_score") / F.col("n_words") * 1e6 + 0.001) / 1e6)
    return rows.select("doc_id", "n_words", "n_seen", mean.alias("mean_log_score"))


_SQL_WORDS = ("list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
              r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, instr('13579bdf', substr(md5(coalesce(text, '')), 1, 1)) > 0 AS half, {_SQL_WORDS} AS w FROM documents),
p AS MATERIALIZED (SELECT rid, half, i, w[i] AS z, CASE WHEN i > 1 THEN w[i - 1] END AS y, CASE WHEN i > 2 THEN w[i - 2] END AS x
  FROM (SELECT rid, half, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
n AS (SELECT NOT half AS half, count(*) AS t FROM p GROUP BY 1),
u AS (SELECT NOT half AS half, z, CAST(count(*) AS DOUBLE) AS c FROM p GROUP BY ALL),
b AS (SELECT NOT half AS half, y, z, CAST(count(*) AS DOUBLE) AS c FROM p WHERE i > 1 GROUP BY ALL),
t AS (SELECT NOT half AS half, x, y, z, CAST(count(*) AS DOUBLE) AS c FROM p WHERE i > 2 GROUP BY ALL),
s AS (SELECT p.rid, t.c IS NOT NULL AS seen,
        CASE WHEN t.c IS NOT NULL THEN ln(t.c / h2.c)
             WHEN b.c IS NOT NULL THEN ln(b.c / h1.c) + CASE WHEN p.i > 2 THEN ln({WEIGHT}) ELSE 0 END
             ELSE ln(coalesce(u.c, {OOV}) / n.t) + least(p.i - 1, 2) * ln({WEIGHT}) END AS l
      FROM p LEFT JOIN n ON n.half = p.half LEFT JOIN u ON u.half = p.half AND u.z = p.z
      LEFT JOIN u h1 ON h1.half = p.half AND h1.z = p.y
      LEFT JOIN b ON b.half = p.half AND b.y = p.y AND b.z = p.z LEFT JOIN b h2 ON h2.half = p.half AND h2.y = p.x AND h2.z = p.y
      LEFT JOIN t ON t.half = p.half AND t.x = p.x AND t.y = p.y AND t.z = p.z),
a AS (SELECT rid, count(*) FILTER (WHERE seen) AS n_seen, avg(l) AS l FROM s GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_seen, 0) AS n_seen,
       round(l * CAST(1000000 AS DOUBLE) + CAST(0.001 AS DOUBLE)) / CAST(1000000 AS DOUBLE) AS mean_log_score
FROM d LEFT JOIN a USING (rid)
"""
