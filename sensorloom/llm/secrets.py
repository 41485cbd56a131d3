"""Secret scan with a random forest against false positives (operator 4).

Candidates are long runs of key characters with a digit or a change of case.
Their features are length, character transitions, dictionary coverage, path and
neighbouring words; the dictionary is the most widespread words of the corpus
itself, counted over all documents.  The forest is fitted on labelled findings:
a table of them if one is given, else findings that seed rules decide (known
key formats and assignments; plain numbers, words and padding), at most about
``sample_rows`` of either kind drawn by hash.  Seed labels are for the fit only:
the forest's probability decides every finding.  Extraction is an Arrow pass,
fitting and scoring are MLlib.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.session import written
from sensorloom.sources.tables import table

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{12,}={0,2}")
MIXED = re.compile(r"[0-9]|[a-z][A-Z]|[A-Z][A-Z0-9]{15}")
WORD = re.compile(r"(?<!\w)[^\W\d_]{3,20}(?!\w)")
NEXT = re.compile(r"[^\W_]+")
# What assigns a secret, known formats, and marks of paths.
ASSIGN = re.compile(r"""(?i)(?:token|passw(?:or)?d|pwd|secret|credential|api[_-]?key|access[_-]?key|private[_-]?key)["']?\s*(?:=>|[:=])\s*["']?$""")
FORMATS = re.compile(r"(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}")
PATH_MARKS = ["test", "example", "sample", "doc", "vendor", "fixture", ".md", ".env", "conf"]
BUCKETS = 16
CLASSES = 5  # digit, lower, upper, other ASCII, rest


def char_classes(s: str) -> list[int]:
    return [0 if "0" <= c <= "9" else 1 if "a" <= c <= "z" else 2 if "A" <= c <= "Z" else 3 if c < "\x80" else 4 for c in s]


class Dictionary:
    """Words for coverage, and letter pairs of those words for how word-like a run is."""

    def __init__(self, words: list[str]):
        self.words = frozenset(words)
        pairs = Counter(p for w in words for p in zip("^" + w, w + "$"))
        first = Counter(p[0] for w in words for p in zip("^" + w, w + "$"))
        self.pairs = {p: math.log((n + 1) / (first[p[0]] + 30)) for p, n in pairs.items()}

    def coverage(self, s: str) -> float:
        """Share of the letters that dictionary words of four or more letters cover, longest first from the left."""
        s, covered, k = s.lower(), 0, 0
        letters = sum(c.isalpha() for c in s)
        while k < len(s):
            size = next((n for n in range(min(20, len(s) - k), 3, -1) if s[k: k + n] in self.words), 0)
            covered += size
            k += size or 1
        return covered / letters if letters else 0.0

    def wordiness(self, s: str) -> float:
        """Mean log odds of neighbouring letters."""
        runs = [("^" + r, r + "$") for r in re.findall("[a-z]+", s.lower())]
        logs = [self.pairs.get(p, -6.0) for a, b in runs for p in zip(a, b)]
        return sum(logs) / len(logs) if logs else -6.0


def bucket(word: str) -> int:
    return xxhash.xxh32_intdigest(word.lower()) % BUCKETS if word else -1


def features(value: str, before: str, after: str, path: str, words: Dictionary) -> list[float]:
    kinds = char_classes(value)
    steps = np.zeros((CLASSES, CLASSES))
    for a, b in zip(kinds, kinds[1:]):
        steps[a, b] += 1
    counts = Counter(value)
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    left, right = (NEXT.findall(before) or [""])[-1], (NEXT.findall(after) or [""])[0]
    near = [0.0] * (2 * BUCKETS)
    for k, w in ((0, left), (BUCKETS, right)):
        if w:
            near[k + bucket(w)] = 1.0
    path = path.lower()
    hexa = sum(c in "0123456789abcdefABCDEF" for c in value) / n
    return [float(n), entropy, len(counts) / n, max(counts.values()) / n, hexa, words.coverage(value), words.wordiness(value),
            *[kinds.count(k) / n for k in range(CLASSES - 1)], *(steps[:4, :4].ravel() / max(1, n - 1)).tolist(),
            float(bool(ASSIGN.search(before))), float(before.rstrip(" \"'").endswith(("=", ":"))), float(before.endswith(('"', "'"))),
            float(after.startswith(('"', "'"))), float(value.endswith("=")), words.coverage(left), float(path.count("/")),
            *[float(m in path) for m in PATH_MARKS], *near]


def seed_label(value: str, before: str, words: Dictionary) -> float | None:
    """1 and 0 where a rule labels a finding for the fit, None elsewhere."""
    if FORMATS.fullmatch(value):
        return 1.0
    kinds = char_classes(value.rstrip("="))
    letters = (kinds.count(1) + kinds.count(2)) / max(1, len(kinds))
    if set(kinds) <= {0, 3} or max(Counter(value).values()) > 0.5 * len(value) or words.coverage(value) * letters >= 0.6:
        return 0.0
    if ASSIGN.search(before) and 0 in kinds and len(kinds) >= 16:
        return 1.0
    return None


def candidates_of(text: str | None) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, value, up to 40 characters before, after), offsets in code points; short or plain runs are none."""
    for m in CANDIDATE.finditer(text or ""):
        if MIXED.search(m.group()):
            yield m.start(), m.end(), m.group(), text[max(0, m.start() - 40): m.start()], text[m.end(): m.end() + 40]


def dictionary(docs: DataFrame, size: int = 20_000, text: str = "text") -> Dictionary:
    """The words in at least 2**k documents of ``docs``, for the smallest k that gives at most ``size`` words.

    All documents count; the driver gets a row per power of two, and then at most ``size`` words."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for pdf in batches:
            for t in pdf.text:
                seen.update(set(WORD.findall((t or "").lower())))
                if len(seen) > 200_000:
                    yield pd.DataFrame(seen.items(), columns=["word", "n"])
                    seen = Counter()
        yield pd.DataFrame(seen.items(), columns=["word", "n"]).astype({"word": "object", "n": "int64"})

    words = docs.select(F.col(text).alias("text")).mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = written(words.where("n > 1").withColumn("k", F.floor(F.log2("n"))), "words")
    level, total = 64, 0
    for r in words.groupBy("k").count().orderBy(F.desc("k")).collect():
        total += r["count"]
        if total > size:
            break
        level = r.k
    return Dictionary([r.word for r in words.where(F.col("k") >= level).orderBy("word").select("word").collect()])


def findings(docs: DataFrame, words: Dictionary, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """``doc_id, text_hash, start, end, value, label, x`` of every candidate; ``x`` the features, ``label`` what a seed rule says."""
    known = docs.sparkSession.sparkContext.broadcast(words)
    # the id travels as text: pandas would turn a column with nulls into floats
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"),
                       F.col(path).cast("string").alias("path"))
    names = ["doc_id", "text_hash", "start", "end", "value", "label", "x"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = known.value
        for pdf in batches:
            out = []
            for d, h, t, p in zip(pdf.doc_id, pdf.text_hash, pdf.text, pdf.path):
                for start, end, value, before, after in candidates_of(t):
                    out.append((d, h, start, end, value, seed_label(value, before, words), features(value, before, after, p or "", words)))
            got = pd.DataFrame(out, columns=names)
            yield got.astype({"label": "float64"})

    kind = docs.schema[doc_id].dataType.simpleString()
    out = rows.mapInPandas(run, "doc_id string, text_hash long, start int, end int, value string, label double, x array<double>")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def fit(labelled: DataFrame, sample_rows: int = 20_000, trees: int = 40, depth: int = 8, seed: int = 11):
    """A forest fitted on about ``sample_rows`` different findings of each label of ``labelled(label, x)``, or None without both labels.

    Equal findings are one row with their number as its weight: copies are not drawn together or left out
    together, and a hot one is no more than a row.  The draw is by hash and the rows are ordered, so that equal
    tables give equal forests; both labels are checked again after it."""
    distinct = labelled.where("label IS NOT NULL").groupBy("label", "x").agg(F.count("*").cast("double").alias("weight"))
    key = F.xxhash64(F.col("x").cast("string"), F.lit(seed))
    rows = written(distinct.select("label", array_to_vector("x").alias("v"), "weight", key.alias("k")), "labelled")
    sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if set(sizes) < {0.0, 1.0}:
        return None
    wanted = F.lit(False)
    for value, n in sizes.items():
        wanted = wanted | ((F.col("label") == value) & (F.pmod(F.col("k"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, sample_rows / n))))
    sample = written(rows.where(wanted).repartition(1).sortWithinPartitions("k", "label"), "sample")
    if sample.select("label").distinct().count() < 2:
        return None
    return RandomForestClassifier(featuresCol="v", labelCol="label", weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed).fit(sample.coalesce(1))


def scored(found: DataFrame, model) -> DataFrame:
    """``found`` with ``score``: the forest's probability of a secret; without a forest what the seed rules say."""
    if model is None:
        return found.withColumn("score", F.coalesce("label", F.lit(0.0)))
    rows = model.transform(found.withColumn("v", array_to_vector("x")))
    return rows.select(*found.columns, vector_to_array("probability")[1].alias("score"))


def secrets(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5, sample_rows: int = 20_000,
            doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """``doc_id, text_hash, spans`` (sorted (start, end) of secrets) and ``n_candidates`` of each distinct (id, text) with a candidate.

    Null and empty texts have none; a null path is an empty one; repeated rows
    share one result; an empty table, or one without labels of both kinds,
    falls back to the seed rules.  Other columns are not read."""
    found = written(findings(docs, dictionary(docs, text=text), doc_id, text, path), "findings")
    rows = scored(found, fit(labelled if labelled is not None else found, sample_rows))
    spans = F.collect_set(F.when(F.col("score") >= threshold, F.struct("start", "end")))
    return rows.groupBy("doc_id", "text_hash").agg(F.sort_array(spans).alias("spans"), F.countDistinct("start").alias("n_candidates"))


def redact(docs: DataFrame, threshold: float = 0.5, mark: str = "[SECRET]") -> DataFrame:
    """``documents`` with every secret replaced by ``mark``; no row goes, ``n_chars`` follows changed texts.

    Null and empty texts stay as they are; repeated rows change alike; an empty table gives an empty result."""
    found = secrets(docs, threshold=threshold).where("size(spans) > 0")
    found = written(found.select(F.col("doc_id").alias("__sl_id"), F.col("text_hash").alias("__sl_hash"), F.col("spans").alias("__sl_spans")), "secrets")
    rows = docs.join(found, docs["doc_id"].eqNullSafe(F.col("__sl_id")) & (F.xxhash64(docs["text"]) == F.col("__sl_hash")), "left")
    text = F.aggregate("__sl_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), lambda acc, s: F.struct(
        s["end"].alias("at"), F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    hit = F.col("__sl_spans").isNotNull()
    rows = rows.withColumn("text", F.when(hit, text).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(hit, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(docs.columns)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: candidates and secrets of every document, also of those without."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = secrets(docs)
    found = found.select(F.col("doc_id").alias("f_id"), F.col("text_hash").alias("f_hash"), "spans", "n_candidates")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("text_hash") == F.col("f_hash")), "left")
    zero = F.lit(0).cast("long")
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return rows.select("doc_id", F.coalesce("n_candidates", zero).alias("n_candidates"),
                       F.coalesce(F.size("spans").cast("long"), zero).alias("n_secrets"), F.coalesce(listed, F.lit("")).alias("spans"))
