"""Benchmark decontamination by n-gram windows (operator 6), in DataFrame functions only.

The windows of the benchmark items are a table of hashes; while it has at most
``broadcast_rows`` rows (8 bytes each, counted first) every task holds it as a
hash set and documents are scanned where they lie, else it is shuffled against
the documents' windows.  A hit's words are compared with the item's words, so
a result never rests on a hash.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.session import written
from sensorloom.sources.tables import table

WINDOW = 10
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # before lower-casing
BROADCAST_ROWS = 4_000_000


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; null and empty texts have none."""
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(F.array_remove(F.split(lower, BREAKS), ""), F.array().cast("array<string>"))


def _slices(size: Column, make) -> Column:
    """``make(i)`` for each 0-based start of the windows of ``size`` words; none if the words are fewer."""
    n = F.size("words")
    none = F.transform(F.array().cast("array<int>"), make)
    return F.when(n >= size, F.transform(F.sequence(F.lit(0), n - size), make)).otherwise(none)


def _hash(i: Column) -> Column:
    return F.xxhash64(F.col("m"), F.slice("words", i + 1, F.col("m")))


def item_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``item_id, m, h, gram``: the distinct windows of the items; an item of fewer words is one window."""
    # explode of one element keeps the words from being computed again for each window
    items = benchmark.select(F.col(item_id).alias("item_id"), F.explode(F.array(words_of(F.col(text)))).alias("words"))
    items = items.where(F.size("words") > 0).withColumn("m", F.least(F.lit(window), F.size("words")))
    grams = items.select("item_id", "m", "words", F.explode(_slices(F.col("m"), lambda i: i)).alias("i"))
    return grams.select("item_id", "m", _hash(F.col("i")).alias("h"), F.slice("words", F.col("i") + 1, F.col("m")).alias("gram")).distinct()


def hits(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
         broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``doc_id, text_hash, spans, items`` of the documents in which a window occurs.

    ``spans`` are the disjoint ranges ``(start, end)`` of hit words, in order;
    ``items`` the distinct item ids.  Windows of items with a null id hit but
    are not listed.  Repeated rows (same id and text) share one row here."""
    spark = docs.sparkSession
    grams = written(item_windows(benchmark, window=window), "windows")
    sizes = sorted(r.m for r in grams.select("m").distinct().collect())  # at most `window` numbers
    keys = grams.select(F.col("h").alias("key")).distinct()
    if grams.count() <= broadcast_rows:
        keys = F.broadcast(keys)
    if not sizes:
        return spark.createDataFrame([], "doc_id " + docs.schema[doc_id].dataType.simpleString() + ", text_hash long, "
                                     "spans array<struct<start:int,end:int>>, items array<string>")
    seen = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), words_of(F.col(text)).alias("words"),
                       F.explode(F.array(*map(F.lit, sizes))).alias("m"))
    seen = seen.select("doc_id", "text_hash", "words", "m", F.posexplode(_slices(F.col("m"), _hash)).alias("start", "h"))
    seen = seen.join(keys, F.col("h") == F.col("key"), "left_semi")
    seen = seen.select("doc_id", "text_hash", "m", "h", "start", F.slice("words", F.col("start") + 1, F.col("m")).alias("gram"))
    found = seen.join(grams, ["m", "h", "gram"])
    found = found.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("m")).alias("end")))).alias("spans"),
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    return found.withColumn("spans", _disjoint(F.col("spans")))


def _disjoint(spans: Column) -> Column:
    """Sorted ranges with those that touch or overlap made one."""
    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["start"]),
                      F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))
                      ).otherwise(F.concat(done, F.array(s)))
    return F.aggregate(spans, F.array().cast("array<struct<start:int,end:int>>"), add)


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                  broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items, spans`` per row of ``docs``.

    Null and empty texts have no words and no hits; an empty benchmark hits
    nothing; a null doc_id is a row like others; columns beside the two named
    are not read."""
    found = hits(docs, benchmark, doc_id, text, window, broadcast_rows)
    found = found.select(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"), "spans", "items")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"))
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_hash") == F.col("found_hash")), "left")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    items = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select("doc_id", "n_words", F.coalesce(n_hit, F.lit(0).cast("long")).alias("n_hit"),
                       F.size(items).cast("long").alias("n_items"), items.alias("items"), "spans")


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, drop_share: float = 0.5,
                 broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``documents`` without benchmark passages: hit words go, and documents with more than ``drop_share`` of them.

    Text outside the hit spans stays as it is; ``n_chars`` is set anew in
    changed rows if the table has it.  Rows without hits pass unchanged, null
    and empty texts among them; repeated rows change alike; either table may be
    empty."""
    found = hits(docs, benchmark, window=window, broadcast_rows=broadcast_rows)
    found = found.select(F.col("doc_id").alias("__sl_id"), F.col("text_hash").alias("__sl_hash"), F.col("spans").alias("__sl_spans"))
    rows = docs.join(found, docs["doc_id"].eqNullSafe(F.col("__sl_id")) & (F.xxhash64(docs["text"]) == F.col("__sl_hash")), "left")
    clean = rows.where("__sl_spans IS NULL").select(docs.columns)
    hit = rows.where("__sl_spans IS NOT NULL")
    hit = hit.select(*docs.columns, "__sl_spans", F.explode(F.array(F.struct(
        F.regexp_extract_all("text", F.lit(WORD), 0).alias("words"), F.split("text", WORD, -1).alias("gaps")))).alias("__sl_t"))
    n_hit = F.aggregate("__sl_spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    hit = hit.where(n_hit <= F.size("__sl_t.words") * F.lit(drop_share))

    def inside(i: Column) -> Column:
        return F.exists("__sl_spans", lambda s: (i >= s["start"]) & (i < s["end"]))

    pieces = F.transform("__sl_t.gaps", lambda gap, i: F.concat(
        F.when(inside(i) & inside(i - 1), "").otherwise(gap),
        F.when(inside(i), "").otherwise(F.coalesce(F.try_element_at("__sl_t.words", i + 1), F.lit("")))))
    hit = hit.withColumn("text", F.array_join(pieces, ""))
    if "n_chars" in docs.columns:
        hit = hit.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.unionByName(hit.select(docs.columns))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: hit words and items of every document."""
    rows = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))


_SQL_WORDS = ("list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
              r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
bm AS (SELECT *, least({WINDOW}, len(w)) AS m FROM b WHERE len(w) > 0),
g AS (SELECT DISTINCT item_id, m, w[i + 1:i + m] AS gram FROM (SELECT *, unnest(range(0, len(w) - m + 1)) AS i FROM bm)),
ms AS (SELECT DISTINCT m FROM bm),
o AS (SELECT rid, m, i, w[i + 1:i + m] AS gram
      FROM (SELECT rid, w, m, unnest(range(0, greatest(len(w) - m + 1, 0))) AS i FROM d, ms)),
hit AS (SELECT o.rid, o.i, o.m, g.item_id FROM o JOIN g ON o.m = g.m AND o.gram = g.gram),
n AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT rid, i, m FROM hit)) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s COLLATE "C") AS items
       FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS s FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN it USING (rid)
""".replace(' COLLATE "C"', "")
