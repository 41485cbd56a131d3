"""SimHash near-duplicates by tiled exact comparison (operator 7).

1. A 64-bit fingerprint per text (numpy in tasks).
2. Equal fingerprints collapse to one row, so exact copies cost nothing.
3. Tiles: distinct fingerprints are dealt by the set-bit counts of their two
   halves (at most 33 x 33 tiles); a tile over ``block`` rows is cut into
   blocks.  The bit counts of two fingerprints differ by at most their distance,
   so a tile is joined only to tiles whose counts lie within the radius, and
   inside a pair of blocks the counts of the four quarters skip once more.
4. A task compares two blocks with exclusive-or and bit counts, and returns
   for each connected fingerprint its root within the two blocks: at most one
   row per fingerprint, however many pairs are near.
5. Components over those rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm.components import connected_components
from sensorloom.session import settings, written
from sensorloom.sources.tables import table

SEED = 42
SHINGLE, RADIUS = 4, 4


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text; no words or null: 0.

    Words are runs without ASCII white space, A-Z lower-cased.  A bit is 1 if it
    is set in more than half of the shingles' hashes."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    n = min(shingle, len(words))
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(joined[a:b], SEED) for a, b in zip(starts[: len(words) - n + 1].tolist(), ends[n - 1:].tolist())),
                         dtype="<u8", count=len(words) - n + 1)
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 1 << 16):  # a long text needs no more memory than a short one
        part = hashes[k: k + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, out: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint as a signed long in ``out``."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype="<u8").view("<i8"))

    return docs.withColumn(out, fp(F.col(text)))


def _quarters(fp: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fp.view("<u2").reshape(-1, 4)).astype(np.int16)


def _hang(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the components of the edges (i, j) in ``labels``, which holds each node's root."""
    while True:
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while (up := labels[labels]).tobytes() != labels.tobytes():
            labels[:] = up


def _near(a: np.ndarray, b: np.ndarray, radius: int, cells: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within ``radius``, in pieces of bounded size."""
    step = max(1, cells // max(1, len(b)))
    for k in range(0, len(a), step):
        i, j = np.nonzero(np.bitwise_count(a[k: k + step, None] ^ b[None, :]) <= radius)
        if len(i):
            yield i + k, j


def block_roots(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, its root's fingerprint) of those linked between the blocks, or within one (b None)."""
    nodes = a if b is None else np.concatenate([a, b])
    labels, right, at = np.arange(len(nodes)), (a if b is None else b), (0 if b is None else len(a))
    if len(a) * len(right) <= 1 << 22:
        for i, j in _near(a, right, radius):
            _hang(labels, i, j + at)
    else:  # sub-tiles of equal quarter counts
        qa, qb = _quarters(a), _quarters(right)
        ua, ia = np.unique(qa, axis=0, return_inverse=True)
        ub, ib = np.unique(qb, axis=0, return_inverse=True)
        rows_b = [np.nonzero(ib.ravel() == k)[0] for k in range(len(ub))]
        for k, q in enumerate(ua):
            mine = np.nonzero(ia.ravel() == k)[0]
            close = np.nonzero(np.abs(ub - q).sum(axis=1) <= radius)[0]
            if len(close):
                theirs = np.concatenate([rows_b[c] for c in close])
                for i, j in _near(a[mine], right[theirs], radius):
                    _hang(labels, mine[i], theirs[j] + at)
    moved = np.nonzero(labels != np.arange(len(nodes)))[0]
    return nodes[moved], nodes[labels[moved]]


def near_edges(fps: DataFrame, radius: int = RADIUS, block: int = 8192) -> DataFrame:
    """``(u, v)`` edges that connect exactly the distinct fingerprints ``fps(fp)`` linked within ``radius``."""
    low = F.lit(0xFFFFFFFF).cast("long")
    dealt = fps.select("fp", F.bit_count(F.shiftrightunsigned("fp", 32)).alias("hi"),
                       F.bit_count(F.col("fp").bitwiseAND(low)).alias("lo"))
    # at most 33 x 33 rows, whatever the input
    tiles = dealt.groupBy("hi", "lo").agg(F.ceil(F.count("*") / F.lit(block)).alias("blocks"))
    tiles = F.broadcast(written(tiles, "tiles"))
    blocks = (dealt.join(tiles, ["hi", "lo"])
              .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("blocks")))
              .groupBy("hi", "lo", "part").agg(F.collect_list("fp").alias("fps")))
    blocks = written(blocks, "blocks")
    reach = [(x, y) for x in range(-radius, radius + 1) for y in range(-radius, radius + 1) if abs(x) + abs(y) <= radius]
    offsets = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in reach])
    left = blocks.select(F.col("hi").alias("hi_a"), F.col("lo").alias("lo_a"), F.col("part").alias("part_a"),
                         F.col("fps").alias("a"), F.explode(offsets).alias("o"))
    left = left.select("*", (F.col("hi_a") + F.col("o.x")).alias("hi"), (F.col("lo_a") + F.col("o.y")).alias("lo")).drop("o")
    left = left.join(tiles, ["hi", "lo"]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    # each pair of blocks once
    left = left.where("(hi_a, lo_a, part_a) <= (hi, lo, part)")
    pairs = left.join(blocks.withColumnRenamed("fps", "b"), ["hi", "lo", "part"])
    pairs = pairs.select("a", "b", F.expr("(hi_a, lo_a, part_a) = (hi, lo, part)").alias("own"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a, b, own in zip(pdf.a, pdf.b, pdf.own):
                a, b = np.asarray(a, "<i8").view("<u8"), np.asarray(b, "<i8").view("<u8")
                u, v = block_roots(a, None if own else b, radius)
                if len(u):
                    yield pd.DataFrame({"u": u.view("<i8"), "v": v.view("<i8")})

    with settings(fps.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="32"):
        return written(pairs.mapInPandas(compare, "u long, v long"), "near")


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id, text_hash, fp, component_id``: one row per row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable over links of at most
    ``radius`` differing bits.  Null and empty texts have fingerprint 0 and link
    to each other like any others.  A null ``doc_id`` takes part but is never a
    component's id; a component of null ids only has a null id.  Repeated rows
    each get their row.  Other columns are not read.  An empty table gives an
    empty result."""
    rows = with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", shingle)
    rows = written(rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "fp"), "fingerprints")
    fps = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = connected_components(near_edges(fps.select("fp"), radius))
    rooted = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    known = written(rooted.join(least, "root").select("fp", "component_id"), "known")
    return rows.join(known, "fp").select("doc_id", "text_hash", "fp", "component_id")


def keep_one_per_group(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``documents`` without near-duplicates: of each group the row with the smallest doc_id stays.

    Ties on doc_id fall to the smallest text hash, ties on both to the row with
    the smallest hash of all columns, the same on every run.  Groups without any
    id keep one row too; null and empty texts form groups like others; an empty
    table gives an empty result."""
    rows = simhash_groups(docs, shingle=shingle, radius=radius)
    # a null id sorts last
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    group = F.when(F.col("component_id").isNull(), F.col("fp")), F.col("component_id")
    firsts = rows.groupBy(group[0].alias("g"), group[1].alias("c")).agg(F.min(order).alias("k"))
    copies = rows.groupBy("doc_id", "text_hash").agg(F.count("*").alias("__sl_copies"))
    firsts = firsts.select(F.col("k.doc_id").alias("__sl_id"), F.col("k.text_hash").alias("__sl_hash")).distinct()
    same = F.col("__sl_id").eqNullSafe(F.col("doc_id")) & (F.col("__sl_hash") == F.col("text_hash"))
    firsts = written(firsts.join(copies, same).select("__sl_id", "__sl_hash", "__sl_copies"), "firsts")
    hit = docs.join(firsts, F.col("__sl_id").eqNullSafe(docs["doc_id"]) & (F.col("__sl_hash") == F.xxhash64(docs["text"])))
    one = hit.where("__sl_copies = 1").select(docs.columns)
    whole = F.struct(*[docs[c].alias(c) for c in docs.columns])
    # JSON, since a map has no hash
    least = hit.where("__sl_copies > 1").groupBy("__sl_id", "__sl_hash").agg(F.min_by(whole, F.xxhash64(F.to_json(whole))).alias("__sl_row"))
    return one.unionByName(least.select("__sl_row.*"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: every document's fingerprint and component."""
    rows = simhash_groups(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
