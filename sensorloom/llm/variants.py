"""Spelling variants by a relational trie frontier (operator 11).

1. Words and their numbers: tasks count runs of letters text by text and sum what
   they have before anything is shuffled.
2. A pair of words at one edit agrees in its first or in its last half.  So words
   stand in tries forwards and, reversed, backwards, and the search of a word begins
   where its first half ends: the half leads to one node without a search.  There
   is a trie for every length of word (root = direction, kind of edit, length), so a
   search for a replacement sees words of its own length only, one for an insertion
   those that are longer by one.  Deletions are insertions seen from the other word.
3. All searches advance level by level.  A state is (word, position, node, edits); the
   edge table of a level is (node, character, child, words below, one of them).  A state
   without edits follows its own character, and takes every other edge as a
   replacement or an insertion; a state with one edit follows its own character only.
   An edge with a single word below is terminal: the word is compared at once.
4. The edge table of the next level is built from the words that still share a node.
   Both tables are joined on the node, hashed over the cluster, and written level by
   level; there are as many levels as two words of one length share characters
   after their half.

Nodes are 64-bit hashes of the path; two paths of one hash only add words to compare,
since every pair is verified on the words themselves.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.session import written
from sensorloom.sources.tables import table

RUN = "[a-zÀ-ÿ]"
SHORTEST, LEAST, RATIO, TYPO = 6, 5, 5, 199


def runs(doc_id: int | None, text: str, shortest: int = SHORTEST, typo: int = TYPO) -> Iterator[tuple[str, int]]:
    """``(word, number)`` of a text: A-Z lower-cased, and one code point gone from the runs whose checksum ``typo`` divides."""
    low = text.encode("utf-8").lower().decode("utf-8")  # bytes: only A-Z change
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(re.findall(f"{RUN}{{{shortest},}}", low)).items():
        h = crc32(run.encode("utf-8"), start)
        if h % typo == 0:
            gone = h % len(run)
            run = run[:gone] + run[gone + 1:]
            if len(run) < shortest:
                continue
        yield run, n


def words(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, held: int = 400_000) -> DataFrame:
    """``word, n`` of the words with ``least`` occurrences in all texts; a task holds at most about ``held`` sums at a time."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: Counter = Counter()

        def out() -> pd.DataFrame:
            frame = pd.DataFrame({"word": list(sums.keys()), "n": list(sums.values())})
            sums.clear()
            return frame
        for pdf in batches:
            for doc_id, text in zip(pdf.doc_id.to_numpy(object), pdf.text):
                for word, n in runs(None if pd.isna(doc_id) else int(doc_id), text, shortest):
                    sums[word] += n
                if len(sums) > held:
                    yield out()
        if sums:
            yield out()

    rows = docs.where("text is not null").select("doc_id", "text").mapInPandas(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _node(*path: Column) -> Column:
    return F.xxhash64(*path)


def _char(key: str, place: Column) -> Column:
    """The character at ``place`` (from 0), or no characters after the end."""
    return F.substring(F.col(key), place + 1, F.lit(1))


def _starts(rows: DataFrame) -> DataFrame:
    """``back, longer, role, key, pos, node, edits`` of the first level: every word as a search and as a path, in four tries each."""
    size = F.length("word")
    turned = F.explode(F.array(F.lit(False), F.lit(True))).alias("back")
    both = rows.select("word", size.cast("int").alias("size"), turned)
    both = both.select("*", F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word")).alias("key"))
    # the search: for words as long, and for those longer by one; the path: found by words as long, and by shorter ones
    kinds = [("search", False, 0, 0), ("search", True, 0, 1), ("path", False, 0, 0), ("path", True, -1, 0)]
    kind = F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.lit(g).alias("longer"), F.lit(a).alias("asks"), F.lit(t).alias("of"))
                               for r, g, a, t in kinds]))
    each = both.select("key", "back", "size", kind.alias("k"))
    asking = F.col("size") + F.col("k.asks")  # the length of the searching word
    half = F.floor(asking / 2).cast("int")
    skip = F.when(F.col("back"), asking - half).otherwise(half)
    root = _node("back", "k.longer", F.col("size") + F.col("k.of"), F.substring(F.col("key"), F.lit(1), skip))
    return each.select("back", "k.longer", "k.role", "key", skip.alias("pos"), root.alias("node"), F.lit(0).alias("edits"))


def near_words(rows: DataFrame) -> DataFrame:
    """``a, b``: each two of the distinct words ``rows(word)`` that differ by one inserted, deleted or replaced code point, once."""
    now = written(_starts(rows), "level-0")
    found: list[DataFrame] = []
    level = 0
    while not now.isEmpty():
        level += 1
        # a path's depth is its position; a state's character is that at its position
        now = now.withColumn("c", _char("key", F.col("pos")))
        paths, searches = now.where("role = 'path'"), now.where("role = 'search'")
        edges = paths.groupBy("node", "c").agg(F.count("*").alias("below"), F.min("key").alias("only"))
        edges = edges.withColumnRenamed("c", "edge")
        same, own = F.col("edge") == F.col("c"), F.col("pos") + 1
        # edits = 0: every edge of the node; a replacement is made towards the greater character, so that a pair is found once
        free = searches.where("edits = 0").join(edges, "node").where(same | F.col("longer") | (F.col("edge") > F.col("c")))
        free = free.withColumn("edits", F.when(same, 0).otherwise(1)).withColumn("pos", F.when(~same & F.col("longer"), F.col("pos")).otherwise(own))
        bound = edges.withColumnRenamed("edge", "c").withColumn("edge", F.col("c"))
        tied = searches.where("edits = 1").unionByName(paths).join(bound, ["node", "c"]).withColumn("pos", own)
        columns = ["back", "longer", "role", "key", "pos", _node("node", "edge").alias("node"), "edits", "below", "only"]
        steps = free.select(columns).unionByName(tied.select(columns))
        # a single word below: compared; a backward find that agrees in the first half was found forwards
        plain, other = (F.when(F.col("back"), F.reverse(c)).otherwise(F.col(c)) for c in ("key", "only"))
        half = F.floor(F.length("key") / 2).cast("int")
        again = F.col("back") & (F.substring(plain, F.lit(1), half) == F.substring(other, F.lit(1), half))
        pair = (F.col("role") == "search") & (F.levenshtein("key", "only", 1) == 1) & ~again
        steps = written(steps.where((F.col("below") > 1) | pair), f"level-{level}")
        found.append(steps.where("below = 1").select(plain.alias("a"), other.alias("b")))
        now = steps.where("below > 1").drop("below", "only")
    pairs = found[0] if found else rows.select(F.col("word").alias("a"), F.col("word").alias("b")).limit(0)
    for f in found[1:]:
        pairs = pairs.unionByName(f)
    return pairs


def last_forms(forms: DataFrame) -> DataFrame:
    """``word, root``: the end of the chain that each of ``forms(word, form)`` begins (form null: itself).

    Numbers grow along a chain, so it has no cycle; each round doubles the steps."""
    now = written(forms.where("form is not null").select("word", F.col("form").alias("root")), "forms-0")
    step = 0
    while True:
        step += 1
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = written(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")), f"forms-{step}")
        now = after.select("word", "root")
        if after.where("on").isEmpty():
            return now


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = SHORTEST, least: int = LEAST, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` per word of ``docs``.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, with at least
    ``shortest`` code points and ``least`` occurrences; a code point goes from the runs whose checksum
    with the id ``TYPO`` divides.  A word's form is the near word (one inserted, deleted or replaced code
    point) with the largest number, of equal ones the first in code-point order, if that number is
    ``ratio`` times its own or more.  A null or empty text has no words; a null id counts as no
    characters before the colon.  Repeated rows count again.  Very long texts and runs are read
    whole.  Other columns are not read.  An empty table gives an empty result."""
    found = written(words(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), shortest, least), "words")
    pairs = near_words(found.select("word"))
    links = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    about = links.join(found.select(F.col("word").alias("b"), F.col("n").alias("m")), "b")
    # the largest number, then the first word: the least (-number, word)
    about = about.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "b")).alias("best"))
    rows = found.join(about, "word", "left").withColumn("take", F.coalesce(-F.col("best.m") >= ratio * F.col("n"), F.lit(False)))
    rows = written(rows.select("word", F.when(F.col("take"), F.col("best.b")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                               F.when(F.col("take"), -F.col("best.m")).alias("form_n")), "variants")
    return rows.join(last_forms(rows), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: every word of the documents with its form and root."""
    return variants(table(spark, sf_dir, "documents"))


SQL = f"""WITH RECURSIVE bits(k, v, turn) AS (
  SELECT k, k, 0 FROM range(256) t(k) UNION ALL
  SELECT k, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, turn + 1 FROM bits WHERE turn < 8
), crc AS MATERIALIZED (SELECT list(v ORDER BY k) AS t FROM bits WHERE turn = 8
), runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents) WHERE length(run) >= {SHORTEST} GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
      lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [CAST(192 + (ord(c) // 64) AS BIGINT), CAST(128 + ord(c) % 64 AS BIGINT)] END))),
    lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1]))) AS h
  FROM runs, crc
), words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % {TYPO} = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= {SHORTEST} GROUP BY word HAVING sum(n) >= {LEAST}
), cuts AS MATERIALIZED (
  SELECT word, p, substring(word, 1, p - 1) || substring(word, p + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM words)
), pairs AS (
  SELECT a.word AS a, b.word AS b FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, b.word FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM cuts a JOIN words b ON a.rest = b.word
), best AS (
  SELECT p.a AS word, count(*) AS n_near, arg_min(p.b, (-w.n, p.b)) AS b, max(w.n) AS m FROM pairs p JOIN words w ON p.b = w.word GROUP BY p.a
), forms AS MATERIALIZED (
  SELECT w.word, CASE WHEN b.m >= {RATIO} * w.n THEN b.b END AS form, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= {RATIO} * w.n THEN b.m END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), walk AS (
  SELECT word, word AS at, form AS next FROM forms UNION ALL SELECT k.word, f.word, f.form FROM walk k JOIN forms f ON k.next = f.word
)
SELECT f.word, f.form, k.at AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n FROM forms f JOIN walk k ON k.word = f.word AND k.next IS NULL"""
