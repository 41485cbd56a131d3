"""Repeated passages by sparse suffix arrays (operator 8).

A suffix of a text is kept only where its first ``head`` words are the minimiser
of a window of ``passage`` words; a passage that stands twice has the same
minimisers in both places, so nothing of ``passage`` words or more is missed.

1. Kept suffixes are rows (head, neighbourhood, text, windows): the head are the
   suffix's first words; the neighbourhood is the stretch of text in which this
   minimiser rules, left and right of it.
2. Suffixes of one neighbourhood match over all of it: they collapse into one
   row with a count, by partial aggregates, so a passage in a third of all texts
   is one row per task.  Heads that occur once have no neighbour and drop out.
3. The different suffixes left are sorted by range over the cluster, as are the
   words before them, read backwards; each is compared with its neighbours in
   either array, word by word and over the borders of the ranges, and so every
   run that shares some number of words has a number.
4. A match is extended to the left and right as far as both arrays allow: two
   places that are in one run to the right and in one to the left, ``passage``
   words together, repeat.  Matches that overlap are one span.

A text is known by a 64-bit hash, a neighbourhood by two (head and all of it), a
sorted suffix by one of 128 bits; runs come from comparisons of the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.session import discard, written
from sensorloom.sources.tables import table

PASSAGE, HEAD = 50, 8
BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashed:
    """64-bit hashes of any stretch of a text's words in constant time: a polynomial in an odd base, brought to power 0."""

    INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

    def __init__(self, text: str | None):
        h = xxhash.xxh3_64_intdigest
        words = np.array([h(w) for w in (text or "").encode("utf-8").split()], dtype=np.uint64)
        self.n = len(words)
        one = np.ones(1, np.uint64)
        power = np.concatenate([one, np.multiply.accumulate(np.full(self.n, BASE, np.uint64))])
        self.back = np.concatenate([one, np.multiply.accumulate(np.full(self.n, self.INVERSE, np.uint64))])
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(words * power[: self.n])])

    def stretch(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return _mix((self.sums[b] - self.sums[a]) * self.back[a] + _mix((b - a).astype(np.uint64)))


def minimisers(heads: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` heads the place of the least one, the leftmost of equals."""
    at, value, have = np.arange(len(heads)), heads, 1
    while have < width:
        step = min(have, width - have)
        left, right = value[: len(value) - step], value[step:]
        first = left <= right
        at = np.where(first, at[: len(at) - step], at[step:])
        value = np.where(first, left, right)
        have += step
    return at


def suffixes(text: str | None, passage: int = PASSAGE, head: int = HEAD) -> tuple[np.ndarray, ...]:
    """(head hash, neighbourhood hash, first window, last window, place) of the kept suffixes; fewer words than ``passage``: none."""
    words = Hashed(text)
    if words.n < passage:
        none = np.zeros(0, np.uint64)
        return none, none, *[none.astype(np.int64)] * 3
    k = np.arange(words.n - head + 1)
    heads = words.stretch(k, k + head)
    place = minimisers(heads, passage - head + 1)
    first = np.nonzero(np.diff(place, prepend=-1))[0]
    last = np.append(first[1:], len(place)) - 1
    p = place[first]
    around = _mix(words.stretch(first, last + passage) + _mix((p - first).astype(np.uint64)))
    return heads[p], around, first, last, p


def kept_suffixes(docs: DataFrame, passage: int, head: int) -> DataFrame:
    """``head, around, tid, a, b`` per kept suffix; ``tid`` the hash of the text."""
    rows = docs.select(F.xxhash64("text").alias("tid"), "text").where(F.length("text") >= 2 * passage - 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k in range(0, len(pdf), 512):
                part = pdf.iloc[k: k + 512]
                got = [suffixes(t, passage, head) for t in part.text]
                h, r, a, b, _ = (np.concatenate(c) for c in zip(*got))
                tid = np.repeat(part.tid.to_numpy(), [len(g[0]) for g in got])
                yield pd.DataFrame({"head": h.view("<i8"), "around": r.view("<i8"), "tid": tid, "a": a.astype("<i4"), "b": b.astype("<i4")})

    return rows.mapInPandas(run, "head long, around long, tid long, a int, b int")


def _places(docs: DataFrame, places: DataFrame, passage: int, head: int) -> DataFrame:
    """``tid, a, left, right, lk, rk, l, r`` of the kept suffixes in ``places(tid, a)``: the words from the minimiser to the end of
    the neighbourhood, those before it in reverse, each with a blank behind; 128-bit keys and numbers of words of both."""
    wanted = places.groupBy("tid").agg(F.collect_set("a").alias("firsts"))
    texts = docs.select(F.xxhash64("text").alias("tid"), "text").dropDuplicates(["tid"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, names = xxhash.xxh3_128_digest, ["tid", "a", "left", "right", "lk", "rk", "l", "r"]
        out = []
        for pdf in batches:
            for tid, text, firsts in zip(pdf.tid, pdf.text, pdf.firsts):
                words = text.encode("utf-8").split()
                _, _, first, last, at = suffixes(text, passage, head)
                here = np.isin(first, firsts)
                for f, e, p in zip(first[here].tolist(), last[here].tolist(), at[here].tolist()):
                    right = b" ".join(words[p: e + passage]) + b" "
                    left = b" ".join(words[f:p][::-1]) + b" " if p > f else b""
                    out.append((tid, f, left, right, key(left), key(right), p - f, e + passage - p))
                    if len(out) == 4096:
                        yield pd.DataFrame(out, columns=names)
                        out = []
        if out:
            yield pd.DataFrame(out, columns=names)

    schema = "tid long, a int, left binary, right binary, lk binary, rk binary, l int, r int"
    return texts.join(wanted, "tid").mapInPandas(run, schema)


def _common(a: bytes, b: bytes) -> int:
    """The number of words that two suffixes begin with in common."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return a.count(b" ", 0, n)
    x = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return a.count(b" ", 0, int(x.argmax()))


def neighbour_classes(found: DataFrame, passage: int, name: str) -> DataFrame:
    """``key, classes`` of the sorted array of ``found(key, words, n, least)``: different suffixes, of which ``n`` places hold each.

    Suffixes are sorted by range over the cluster and each is compared with its neighbours.  ``classes[d]`` is the number of
    the first suffix of the run that shares ``d`` words with this one, for every ``d`` that some other place shares too;
    suffixes that share fewer than ``least`` words with any have no row.  A run may go on over the borders of ranges:
    a range sends its first and last suffix and its open runs to the driver, at most ``passage + 1`` numbers a range."""
    spark = found.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = ["part", "key", "classes", "first", "last"]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        # -1: the run began before this range
        start, count, out, opening = np.full(passage + 1, -1, np.int64), 0, [], None
        held = None

        def finish(words, key, n, least, before, after, border):
            shared = words.count(b" ") if n > 1 or border else max(before, after)
            if shared >= least:
                out.append((part, key, classes[: shared + 1].tolist(), None, None))

        for pdf in batches:
            for words, key, n, least in zip(pdf.words, pdf.key, pdf.n, pdf.least):
                if held is None:
                    opening, before = words, 0
                else:
                    before = _common(held[0], words)
                    finish(*held, before, first_row)
                    start[before + 1:] = (part << 40) + count
                # the first suffix of a range has a neighbour elsewhere, so all its depths are told
                first_row = held is None
                held, classes, count = (words, key, n, least, before), start.copy(), count + 1
                if len(out) == 4096:
                    yield pd.DataFrame(out, columns=names)
                    out = []
        if held is not None:
            finish(*held, 0, True)
            out.append((part, None, start.tolist(), opening, held[0]))
            yield pd.DataFrame(out, columns=names)

    ranged = found.repartitionByRange(parts, "words").sortWithinPartitions("words")
    rows = written(ranged.mapInPandas(scan, "part int, key binary, classes array<long>, first binary, last binary"), name)
    borders, carry, last = {}, None, None
    for r in rows.where("key IS NULL").orderBy("part").collect():
        inherit = np.full(passage + 1, r.part << 40, np.int64)
        if carry is not None:
            shared = _common(bytes(last), bytes(r.first))
            inherit[: shared + 1] = carry[: shared + 1]
        ends = np.array(r.classes, np.int64)
        borders[r.part], carry, last = inherit, np.where(ends < 0, inherit, ends), r.last

    def resolve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [np.where(c < 0, borders[part][: len(c)], c) for part, c in zip(pdf.part, pdf.classes)]
            yield pd.DataFrame({"key": pdf.key, "classes": got})

    return rows.where("key IS NOT NULL").mapInPandas(resolve, "key binary, classes array<long>")


def extended(docs: DataFrame, places: DataFrame, passage: int, head: int) -> DataFrame:
    """``tid, a, b`` of windows of the suffixes in ``places(tid, a)`` whose ``passage`` words stand at another of them too.

    A window that has ``o`` words before the minimiser stands twice where another suffix shares ``passage - o`` words to the
    right and ``o`` to the left.  Both are read from sorted arrays, one of the suffixes and one of the words before them, by
    comparing neighbours word by word; the two class numbers of a window are then counted by aggregates, since a group may be
    too large for a task."""
    rows = written(_places(docs, places, passage, head), "places")
    arrays = []
    for side, key, least in (("right", "rk", F.lit(passage) - F.max("l")), ("left", "lk", F.lit(passage) - F.max("r"))):
        found = rows.groupBy(key).agg(F.first(side).alias("words"), F.count("*").alias("n"), least.alias("least"))
        arrays.append(neighbour_classes(found.withColumnRenamed(key, "key"), passage, f"{side}-array").select(
            F.col("key").alias(key), F.col("classes").alias(f"{side}_c")))
    both = rows.select("tid", "a", "l", "r", "lk", "rk").join(arrays[0], "rk").join(arrays[1], "lk")
    low, high = F.greatest(passage - F.col("r"), passage + 1 - F.size("right_c")), F.least(F.col("l"), F.size("left_c") - 1)
    both = both.where(low <= high).select("*", F.explode(F.sequence(low, high)).alias("o"))
    windows = written(both.select(F.get("right_c", passage - F.col("o")).alias("x"), F.get("left_c", F.col("o")).alias("y"), "o", "tid",
                                  (F.col("a") + F.col("l") - F.col("o")).alias("j")), "windows")
    discard(rows)
    twice = windows.groupBy("x", "y", "o").agg(F.count("*").alias("n")).where("n > 1").select("x", "y", "o")
    return windows.join(twice, ["x", "y", "o"]).select("tid", F.col("j").alias("a"), F.col("j").alias("b"))


def _union(spans: Column) -> Column:
    """Sorted (start, end) with those that overlap or touch made one."""
    def add(acc: Column, s: Column) -> Column:
        grown = F.struct(acc["now"]["start"].alias("start"), F.greatest(acc["now"]["end"], s["end"]).alias("end"))
        return F.when(acc["now"].isNull(), F.struct(acc["done"].alias("done"), s.alias("now"))).when(
            s["start"] <= acc["now"]["end"], F.struct(acc["done"].alias("done"), grown.alias("now"))).otherwise(
            F.struct(F.concat(acc["done"], F.array(acc["now"])).alias("done"), s.alias("now")))

    kind = "struct<start:int,end:int>"
    start = F.struct(F.array().cast(f"array<{kind}>").alias("done"), F.lit(None).cast(kind).alias("now"))
    return F.aggregate(spans, start, add, lambda acc: F.when(acc["now"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["now"]))))


def repeated_spans(docs: DataFrame, text: str = "text", passage: int = PASSAGE, head: int = HEAD) -> DataFrame:
    """``tid, spans``: for each distinct text with repetitions, the word ranges (start, end) that lie in some ``passage``-word stretch
    which stands at another place too, in the same text or another row."""
    docs = docs.select(F.col(text).alias("text"))
    kept = written(kept_suffixes(docs, passage, head), "suffixes")
    runs = kept.groupBy("head", "around").agg(F.count("*").alias("n"), F.min(F.struct("tid", "a", "b")).alias("p"))
    runs = written(runs, "runs")
    whole = kept.join(runs.where("n > 1").select("head", "around"), ["head", "around"]).select("tid", "a", "b")
    several = runs.groupBy("head").agg(F.count("*").alias("m")).where("m > 1").select("head")
    rest = runs.join(several, "head").select("p.tid", "p.a")
    found = whole.unionByName(extended(docs, rest, passage, head))
    spans = F.sort_array(F.collect_set(F.struct(F.col("a").alias("start"), (F.col("b") + passage).alias("end"))))
    return found.groupBy("tid").agg(_union(spans).alias("spans"))


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", passage: int = PASSAGE, head: int = HEAD) -> DataFrame:
    """``doc_id, spans`` per row: word ranges that repeat (see repeated_spans), empty where none do.

    Words are runs without ASCII white space, compared as they are.  Null,
    empty and short texts have no spans; repeated rows repeat each other; a null
    doc_id is a row like others; columns beside the two named are not read."""
    found = written(repeated_spans(docs, text, passage, head), "spans").withColumnRenamed("tid", "found")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("tid"))
    rows = rows.join(found, F.col("tid") == F.col("found"), "left")
    return rows.select("doc_id", F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"))


def op8_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: repeated passages of 50 words or more in every document."""
    rows = repeats(table(spark, sf_dir, "documents"))
    n = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return rows.select("doc_id", F.size("spans").cast("long").alias("n_spans"), n.alias("n_repeated"), listed.alias("spans"))


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT rid, i, md5(array_to_string(w[i + 1:i + {PASSAGE}], ' ')) AS h FROM (SELECT rid, w, unnest(range(0, greatest(len(w) - {PASSAGE - 1}, 0))) AS i FROM d)),
t AS (SELECT h FROM g GROUP BY h HAVING count(*) > 1),
r AS (SELECT rid, i FROM g JOIN t USING (h)),
m AS (SELECT rid, i, CASE WHEN i <= lag(i) OVER (PARTITION BY rid ORDER BY i) + {PASSAGE} THEN 0 ELSE 1 END AS new FROM r),
s AS (SELECT rid, i, sum(new) OVER (PARTITION BY rid ORDER BY i) AS k FROM m),
u AS (SELECT rid, min(i) AS a, max(i) + {PASSAGE} AS b FROM s GROUP BY rid, k),
o AS (SELECT rid, count(*) AS n_spans, sum(b - a) AS n_repeated, string_agg(a || ':' || b, ',' ORDER BY a) AS spans FROM u GROUP BY rid)
SELECT doc_id, coalesce(n_spans, 0) AS n_spans, CAST(coalesce(n_repeated, 0) AS BIGINT) AS n_repeated, coalesce(spans, '') AS spans
FROM d LEFT JOIN o USING (rid)
"""
