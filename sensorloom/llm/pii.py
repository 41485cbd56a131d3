"""Personal data with candidate gradient boosting (operator 10), in DataFrame functions and MLlib only.

Base rules find e-mail addresses, IP and card numbers and telephone numbers.
Beside them, high-recall generators propose overlapping spans (numbers with any
separators, dotted numbers, written-out addresses).  A proposal over a valid base
span is a positive label; one over a base match that failed its check, or that is
a piece of a longer identifier, a negative one.  Boosted trees learn format and
context from them, and score the proposals no base rule decides; per generator
a threshold calibrated on held-out labels selects which become spans too.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.session import written
from sensorloom.sources.tables import table

KINDS = ["email", "ip", "card", "phone"]
# Each starts where a run starts, so that a long run is read once and never walked back:
# the matches are those of the plain patterns.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?>\.[A-Za-z0-9-]++)(?:\.[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": "[0-9][.][0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
WIDE = {
    "number": r"(?<![0-9])[+(]?[0-9][0-9().\x20/-]{5,40}[0-9]",
    "dotted": r"(?<![0-9.])[0-9]++(?:\.[0-9]++){2,7}+",
    "written": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}+\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{2,63}+\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z]{2,24}",
}
WIDE_NEEDS = {"number": "[0-9]", "dotted": "[0-9]", "written": r"@|\(at\)|\[at\]"}
CUES = {"mail": "(?i)mail|write|contact", "call": "(?i)tel|phone|call|mobile|fax", "pay": "(?i)card|visa|iban|pay|account", "net": "(?i)host|server|address|ip"}
IP_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
SPAN = "struct<start:int,kind:int,end:int>"


def _found(text: Column, pattern: str, needs: str) -> Column:
    """``array<struct<start, end, match, before, after>>`` of a pattern's matches; offsets in code points."""
    kind = "array<struct<start:int,end:int,match:string,before:string,after:string>>"
    matches, gaps = F.regexp_extract_all(text, F.lit(pattern), 0), F.split(text, pattern, -1)
    none = F.array().cast(kind)

    def add(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["gap"])
        end = start + F.length(p["match"])
        one = F.struct(start.alias("start"), end.alias("end"), p["match"].alias("match"),
                       F.right(p["gap"], F.lit(24)).alias("before"), F.left(p["next"], F.lit(24)).alias("after"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    pairs = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.struct(g.alias("gap"), m.alias("match")))
    pairs = F.zip_with(pairs, F.slice(gaps, 2, F.size(matches)),
                       lambda p, n: F.struct(p["gap"].alias("gap"), p["match"].alias("match"), n.alias("next")))
    walked = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), add, lambda acc: acc["out"])
    return F.when(text.rlike(needs) & text.rlike(pattern), walked).otherwise(none)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    twice = F.transform(F.split(F.reverse(digits), ""), lambda d, i: d.cast("int") * (1 + i % 2))
    return F.aggregate(twice, F.lit(0), lambda s, d: s + F.when(d > 9, d - 9).otherwise(d)) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = F.length(_digits(match))
    return {
        "email": lambda: F.lit(True),
        "ip": lambda: match.rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$"),
        "card": lambda: digits.between(12, 19) & _luhn(_digits(match)),
        "phone": lambda: digits.between(9, 15),
    }[kind]()


def proposals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_hash, base, failed, wide``: valid base spans, base matches that failed, generator proposals with context."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kinds = [_found(F.col("text"), PATTERNS[k], NEEDS[k]).alias(k) for k in KINDS]
    # explode of one element: each pattern is run once
    rows = rows.select("doc_id", "text_hash", F.explode(F.array(F.struct(
        *kinds, *[_found(F.col("text"), p, WIDE_NEEDS[w]).alias(w) for w, p in WIDE.items()]))).alias("m"))

    def span(i: int):
        return lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("kind"), s["end"].alias("end"))

    def passes(kind: str, wanted: bool):
        return lambda s: _valid(kind, s["match"]) == F.lit(wanted)

    def named(generator: str):
        return lambda s: F.struct(F.lit(generator).alias("generator"), *[s[c].alias(c) for c in ("start", "end", "match", "before", "after")])

    base, failed, wide = [], [], []
    for i, k in enumerate(KINDS):
        base.append(F.transform(F.filter(f"m.{k}", passes(k, True)), span(i)))
        failed.append(F.transform(F.filter(f"m.{k}", passes(k, False)), span(i)))
    for w in WIDE:
        wide.append(F.transform(f"m.{w}", named(w)))
    return rows.select("doc_id", "text_hash", F.array_sort(F.concat(*base)).alias("base"), F.concat(*failed).alias("failed"),
                       F.concat(*wide).alias("wide"))


def candidates(found: DataFrame) -> DataFrame:
    """One row per proposal: place, label (1, 0 or null for those to be scored) and format and context features."""
    def over(spans: str) -> Column:
        return F.exists(spans, lambda b: (b["start"] < F.col("w.end")) & (F.col("w.start") < b["end"]))

    rows = found.where("size(wide) > 0").select("doc_id", "text_hash", "base", "failed", F.explode("wide").alias("w"))
    piece = F.col("w.before").rlike("[A-Za-z0-9_]$") | F.col("w.after").rlike("^[A-Za-z0-9_]")
    label = F.when(over("base"), 1.0).when(over("failed") | piece, 0.0)
    m = F.col("w.match")
    kind = F.when(F.col("w.generator") == "written", 0).when(F.col("w.generator") == "dotted", 1).otherwise(
        F.when(F.length(_digits(m)) > 11, 2).otherwise(3))
    rows = rows.select("doc_id", "text_hash", F.col("w.generator").alias("generator"), F.col("w.start").alias("start"),
                       F.col("w.end").alias("end"), kind.alias("kind"), label.alias("label"), m.alias("m"),
                       F.col("w.before").alias("b"), F.col("w.after").alias("a"))
    n = F.length("m").cast("double")
    feats = {"f_length": n, "f_digits": F.length(_digits(F.col("m"))) / n, "f_groups": F.size(F.split("m", "[^0-9]+")).cast("double")}
    for name, chars in {"dots": "[^.]", "blanks": "[^ ]", "hyphens": "[^-]", "letters": "[^A-Za-z]", "parens": "[^()]"}.items():
        feats[f"f_{name}"] = F.length(F.regexp_replace("m", chars, "")).cast("double")
    feats |= {"f_plus": F.col("m").startswith("+").cast("double"), "f_at": F.col("m").contains("@").cast("double"),
              "f_distinct": F.size(F.array_distinct(F.split("m", ""))).cast("double"), "f_zero": F.col("m").rlike("^0").cast("double"),
              "f_blank_before": F.col("b").rlike("(^|[ \n])$").cast("double"), "f_word_before": F.length(F.regexp_extract("b", "([A-Za-z]*)[^A-Za-z]*$", 1)).cast("double"),
              "f_colon": F.col("b").rlike("[:=] *$").cast("double"), "f_stop_after": F.col("a").rlike("^($|[ \n.,;])").cast("double"),
              "f_number_after": F.col("a").rlike("^[ ]?[0-9%]").cast("double")}
    feats |= {f"f_{name}": F.col("b").rlike(p).cast("double") for name, p in CUES.items()}
    feats |= {f"f_{g}": (F.col("generator") == g).cast("double") for g in WIDE}
    return rows.withColumns(feats).drop("m", "b", "a")


def selected(cands: DataFrame, sample_rows: int = 20_000, precision: float = 0.98, trees: int = 12, depth: int = 4, seed: int = 7) -> DataFrame:
    """``doc_id, text_hash, start, kind, end`` of the undecided proposals above their generator's threshold.

    The trees are fitted on about ``sample_rows`` labelled proposals, drawn by a
    hash of their document and place; three in ten of those calibrate instead.  A generator's
    threshold is the lowest score (in hundredths) from which ``precision`` of
    its held-out labels are positive; without such a score, or without labels
    of both classes, it adds nothing.  Equal places in repeated rows count once."""
    names = [c for c in cands.columns if c.startswith("f_")]
    # with the id: the copies of a text are drawn one by one, not all or none
    draw = F.pmod(F.xxhash64("doc_id", "text_hash", "start", "end", "generator", F.lit(seed)), F.lit(1_000_000))
    cands = cands.dropDuplicates(["doc_id", "text_hash", "generator", "start", "end"])
    none = cands.select("doc_id", "text_hash", "start", "kind", "end").limit(0)
    cands = written(VectorAssembler(inputCols=names, outputCol="x").transform(cands.withColumn("draw", draw)).drop(*names), "candidates")
    labelled = cands.where("label IS NOT NULL")
    n, positive = labelled.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    share = min(1.0, sample_rows / max(n, 1))
    sample = labelled.where(F.col("draw") < int(1_000_000 * share))
    held = F.pmod(F.col("draw"), F.lit(10)) < 3
    fit = written(sample.where(~held), "fit")
    if fit.select("label").distinct().count() < 2:
        return none
    model = GBTClassifier(featuresCol="x", labelCol="label", maxIter=trees, maxDepth=depth, seed=seed, checkpointInterval=-1).fit(fit)
    scored = model.transform(cands.where(held | F.col("label").isNull())).withColumn("score", F.floor(vector_to_array("probability")[1] * 100))
    scored = written(scored.select("doc_id", "text_hash", "generator", "start", "kind", "end", "label", "score"), "scored")
    # at most three generators by 101 scores
    table_ = scored.where("label IS NOT NULL").groupBy("generator", "score").agg(F.count("*").alias("n"), F.sum("label").alias("p")).collect()
    over = F.lit(False)
    for g in WIDE:
        mine = [(r.score, r.n, r.p) for r in table_ if r.generator == g]
        good = [s for s, _, _ in mine if sum(p for t, _, p in mine if t >= s) >= precision * sum(k for t, k, _ in mine if t >= s)]
        if good:
            over = over | ((F.col("generator") == g) & (F.col("score") >= min(good)))
    return scored.where(F.col("label").isNull() & over).select("doc_id", "text_hash", "start", "kind", "end")


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_rows: int = 20_000) -> DataFrame:
    """``doc_id, base, spans`` per row: base spans and all spans, as sorted arrays of (start, kind, end).

    ``kind`` indexes KINDS; offsets are code points, end exclusive.  Null and
    empty texts have no spans; rows with equal id and text share their added
    spans; a null doc_id is a row like others; other columns are not read."""
    found = written(proposals(docs, doc_id, text), "proposals")
    added = selected(candidates(found), sample_rows)
    added = added.groupBy(F.col("doc_id").alias("a_id"), F.col("text_hash").alias("a_hash")).agg(
        F.collect_set(F.struct("start", "kind", "end")).alias("added"))
    rows = found.join(added, F.col("doc_id").eqNullSafe(F.col("a_id")) & (F.col("text_hash") == F.col("a_hash")), "left")
    spans = F.array_sort(F.array_union("base", F.coalesce("added", F.array().cast(f"array<{SPAN}>"))))
    return rows.select("doc_id", "base", spans.alias("spans"))


def spans_text(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets; of overlapping spans the first one's kind stands for all."""
    names = F.array(*map(F.lit, KINDS))

    def add(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        mark = F.when(s["start"] < acc["at"], "").otherwise(F.concat(F.lit("["), F.element_at(names, s["kind"] + 1), F.lit("]")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], gap, mark).alias("out"))

    return F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), add,
                       lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def _of_kind(i: int):
    return lambda s: s["kind"] == i


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: base counts and spans of every document."""
    rows = personal_data(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", _of_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(spans_text("base"), 256).alias("base_sha256"), spans_text("spans").alias("spans"))
