"""Near-duplicate vectors by spherical-cap filters (operator 13).

1. Equal vectors collapse to one with a number of copies.
2. Filter directions are ``CODES`` product codes: after a pseudo-random rotation the
   dimensions fall into ``blocks`` parts with ``size`` random unit vectors each, and
   every combination of one vector a part is a direction (size ** blocks a code).
   A vector belongs to all directions whose cap (score of at least a threshold)
   holds it.  They are found by list decoding: part by part, only prefixes that the
   best remaining scores can still lift over the threshold live on.  A vector under
   a code's threshold everywhere takes its best direction, so none is without.
3. The number of directions follows the number of vectors, one in ``FILL`` of them a
   code; the thresholds follow from the directions alone, as those at which all but
   ``MISS`` of random pairs at the least similarity share a cap of some code.
4. Vectors meet by cap, and meetings are verified by cosine.  A pair that shares
   several caps counts in the one of smallest number.  A task returns for each vector
   its number of links and a root, never pairs.
5. Components over the roots.

Scores are sums of integers below 2^53 in doubles, hence equal on every machine and
in every order of summation; caps can be worked out anew wherever they are needed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm.components import connected_components
from sensorloom.llm.simhash import _hang
from sensorloom.session import written
from sensorloom.sources.tables import table

LEAST = 0.9
SEED = 42
#: product codes; vectors for each direction of a code; share of pairs at the least similarity that may share no cap
CODES, FILL, MISS = 8, 8, 0.005
#: most vectors of a part of a cap, and of a comparison at a time
PART, BLOCK = 1 << 15, 512
FINE, CODE = 1 << 20, 1 << 10


def shape(vectors: int, dim: int) -> tuple[int, int]:
    """(blocks, code vectors a block) for a number of vectors."""
    directions = max(256, vectors // FILL)
    blocks = 2
    while directions ** (1 / blocks) > 2048:
        blocks += 1
    blocks = min(blocks, dim)
    return blocks, int(np.ceil(directions ** (1 / blocks)))


class Code:
    """One product code for vectors of one dimension."""

    def __init__(self, number: int, dim: int, blocks: int, size: int, least: float = LEAST, miss: float = MISS ** (1 / CODES), seed: int = SEED):
        self.dim, self.size = dim, size
        rng = np.random.default_rng([seed, number, dim, blocks, size])
        wide = 1 << max(0, dim - 1).bit_length()
        hadamard = np.ones((1, 1))
        while len(hadamard) < wide:
            hadamard = np.block([[hadamard, hadamard], [hadamard, -hadamard]])
        signs = rng.choice([-1.0, 1.0], (2, wide))
        self.turn = ((signs[0][:, None] * hadamard) @ (signs[1][:, None] * hadamard))[:dim]
        self.parts = np.array_split(np.arange(wide), blocks)
        self.codes = []
        for part in self.parts:
            c = rng.normal(size=(size, len(part)))
            c /= np.sqrt((c * c).sum(axis=1, keepdims=True) * blocks)
            self.codes.append(np.rint(c * CODE))
        self.threshold = self._fit(rng, least, miss)

    def _fit(self, rng: np.random.Generator, least: float, miss: float, pairs: int = 2048) -> int:
        """The score that random pairs at cosine ``least`` reach together in some direction, but for a share of ``miss``."""
        a, b = rng.normal(size=(2, pairs, self.dim))
        a /= np.sqrt((a * a).sum(axis=1, keepdims=True))
        b -= (a * b).sum(axis=1, keepdims=True) * a
        b /= np.maximum(np.sqrt((b * b).sum(axis=1, keepdims=True)), 1e-300)
        b = least * a + np.sqrt(1 - least * least) * b
        best = []
        top = max(2, int(2304 ** (1 / len(self.parts))))
        for k in range(0, pairs, 256):
            one, two = self.scores(fine(a[k: k + 256])), self.scores(fine(b[k: k + 256]))
            x, y = np.zeros((2, len(one[0]), 1))
            for s, t in zip(one, two):
                at = np.argsort(-(s + t), axis=1)[:, :top]
                x = (x[:, :, None] + np.take_along_axis(s, at, 1)[:, None, :]).reshape(len(x), -1)
                y = (y[:, :, None] + np.take_along_axis(t, at, 1)[:, None, :]).reshape(len(y), -1)
            best.append(np.minimum(x, y).max(axis=1))
        return int(np.sort(np.concatenate(best))[int(miss * pairs)])

    def scores(self, q: np.ndarray) -> list[np.ndarray]:
        turned = q @ self.turn
        return [turned[:, part] @ c.T for part, c in zip(self.parts, self.codes)]

    def decode(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, direction) of all caps of the rows ``q`` (fine integers)."""
        rows, caps = [], []
        for k in range(0, len(q), 2048):
            scores = self.scores(q[k: k + 2048])
            best = np.array([s.max(axis=1) for s in scores])
            least = np.minimum(self.threshold, best.sum(axis=0))
            n = best.shape[1]
            row, cap, have = np.arange(n), np.zeros(n, np.int64), np.zeros(n)
            for i, s in enumerate(scores):
                rest = best[i + 1:].sum(axis=0)
                others = best.sum(axis=0) - best[i]
                r, j = np.nonzero(s >= (least - others)[:, None])  # no direction needs a worse score here
                first = np.searchsorted(r, np.arange(n + 1))
                many = (first[1:] - first[:-1])[row]
                old = np.repeat(np.arange(len(row)), many)
                new = first[row[old]] + np.arange(len(old)) - np.repeat(np.cumsum(many) - many, many)
                score = have[old] + s[r[new], j[new]]
                live = score + rest[row[old]] >= least[row[old]]
                row, cap, have = row[old][live], cap[old][live] * self.size + j[new][live], score[live]
            rows.append(row + k)
            caps.append(cap)
        return np.concatenate(rows), np.concatenate(caps)


class Caps:
    """The filter directions for vectors of one dimension: all codes, numbered through."""

    def __init__(self, dim: int, blocks: int, size: int, least: float = LEAST):
        self.codes = [Code(k, dim, blocks, size, least) for k in range(CODES)]
        self.each = size ** blocks

    def decode(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cap) of all caps of the rows ``q`` (fine integers), sorted."""
        got = [code.decode(q) for code in self.codes]
        row = np.concatenate([r for r, _ in got])
        cap = np.concatenate([c + k * self.each for k, (_, c) in enumerate(got)])
        order = np.lexsort((cap, row))
        return row[order], cap[order]


@lru_cache(maxsize=8)
def _caps(dim: int, blocks: int, size: int, least: float) -> Caps:
    return Caps(dim, blocks, size, least)


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fine(u: np.ndarray) -> np.ndarray:
    return np.rint(u * FINE)


def usable(vector: str) -> Column:
    """Whether a vector has a direction: components, none null, NaN or infinite, not all zero."""
    number = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & number & F.exists(vector, lambda x: x != 0), F.lit(False))


def meet(ids: np.ndarray, copies: np.ndarray, u: np.ndarray, cap: int, caps: Caps, least: float, at: np.ndarray | None = None):
    """``(id, links, root id)`` of the vectors of one cap that link within it and share no smaller cap.

    ``at``: for two parts of a large cap the part of each row; then only pairs between both."""
    n = len(ids)
    starts = [(a, min(a + BLOCK, n)) for a in range(0, n, BLOCK)]
    links, labels, held = np.zeros(n, np.int64), np.arange(n), {}

    def smaller(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``rows``, cap) of their caps under ``cap``."""
        r, c = caps.decode(fine(u[rows]))
        return r[c < cap], c[c < cap]

    def shared_by_all(a: int, b: int) -> set[int]:
        if (a, b) not in held:
            value, number = np.unique(smaller(np.arange(a, b))[1], return_counts=True)
            held[a, b] = set(value[number == b - a].tolist())
        return held[a, b]

    for k, (a, b) in enumerate(starts):
        for c, d in starts[k:]:
            if at is not None and at[a] == at[b - 1] == at[c] == at[d - 1]:
                continue
            if n > BLOCK and not shared_by_all(a, b).isdisjoint(shared_by_all(c, d)):
                continue  # all these pairs meet in a smaller cap
            near = u[a:b] @ u[c:d].T >= least
            if a == c:
                near = np.triu(near, 1)
            if at is not None:
                near &= at[a:b, None] != at[None, c:d]
            i, j = np.nonzero(near)
            if not len(i):
                continue
            rows_i, at_i = np.unique(i + a, return_inverse=True)
            rows_j, at_j = np.unique(j + c, return_inverse=True)
            (ri, ci), (rj, cj) = smaller(rows_i), smaller(rows_j)
            shared = np.intersect1d(ci, cj)
            if len(shared):
                left, right = np.zeros((len(rows_i), len(shared)), np.float32), np.zeros((len(rows_j), len(shared)), np.float32)
                for m, r, v in ((left, ri, ci), (right, rj, cj)):
                    p = np.searchsorted(shared, v)
                    ok = shared[np.minimum(p, len(shared) - 1)] == v
                    m[r[ok], p[ok]] = 1
                first = (left @ right.T)[at_i, at_j] == 0
                i, j = i[first], j[first]
            if len(i):
                np.add.at(links, i + a, copies[j + c])
                np.add.at(links, j + c, copies[i + a])
                _hang(labels, i + a, j + c)
    hit = np.nonzero(links)[0]
    return ids[hit], links[hit], ids[labels[hit]]


def meet_small(ids: np.ndarray, copies: np.ndarray, u: np.ndarray, cap: np.ndarray, groups: list[tuple[int, int]], caps: Caps, least: float, most: int = 1 << 14):
    """As :func:`meet` for many caps of at most ``BLOCK`` rows each, the rows a to b of ``groups``; caps are decoded once for all."""
    pairs = []
    for a, b in groups:
        i, j = np.nonzero(np.triu(u[a:b] @ u[a:b].T >= least, 1))
        if len(i):
            pairs.append((i + a, j + a))
    if not pairs:
        return np.zeros((3, 0), np.int64)
    i, j = (np.concatenate(p) for p in zip(*pairs))
    rows, at = np.unique(ids[np.concatenate([i, j])], return_index=True)
    place = np.concatenate([i, j])[at]
    row, own = caps.decode(fine(u[place]))
    first = np.searchsorted(row, np.arange(len(rows) + 1))
    width = np.int64(CODES * caps.each)
    known = row * width + own
    x, y, c = np.searchsorted(rows, ids[i]), np.searchsorted(rows, ids[j]), cap[i]
    new = np.ones(len(x), bool)
    for k in range(0, len(x), most):
        part = slice(k, k + most)
        many = first[x[part] + 1] - first[x[part]]
        pair = np.repeat(np.arange(len(many)), many)
        of_x = own[np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many) + first[x[part]][pair]]
        below = of_x < c[part][pair]
        pair, asked = pair[below], y[part][pair[below]] * width + of_x[below]
        p = np.searchsorted(known, asked)
        new[k + pair[known[np.minimum(p, len(known) - 1)] == asked]] = False
    x, y, i, j = x[new], y[new], i[new], j[new]
    links, labels = np.zeros(len(rows), np.int64), np.arange(len(rows))
    np.add.at(links, x, copies[j])
    np.add.at(links, y, copies[i])
    _hang(labels, x, y)
    hit = np.nonzero(links)[0]
    return rows[hit], links[hit], rows[labels[hit]]


def distinct_vectors(rows: DataFrame, vector: str) -> DataFrame:
    """``id, v, copies, first``: a row per usable vector, ``first`` its smallest ``vec_id``; written."""
    one = rows.where(usable(vector)).groupBy(vector).agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    return written(one.select(F.monotonically_increasing_id().alias("id"), F.col(vector).alias("v"), "copies", "first"), "vectors")


def in_caps(vectors: DataFrame, blocks: int, size: int, least: float) -> DataFrame:
    """``dim, cap, id, copies, x``: a row per vector and cap; ``x`` the components as they came, floats or doubles."""
    kind = "<f4" if vectors.schema["v"].dataType.elementType.typeName() == "float" else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch["dim"])
            for dim in np.unique(dims):
                mine = batch.filter(pa.array(dims == dim))
                x = np.asarray(mine["v"].flatten()).astype(kind).reshape(-1, dim)
                row, cap = _caps(int(dim), blocks, size, least).decode(fine(unit(x)))
                for k in range(0, len(row), 1 << 15):
                    r, c = row[k: k + (1 << 15)], cap[k: k + (1 << 15)]
                    packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(x.itemsize * int(dim)), len(r), [None, pa.py_buffer(x[r].tobytes())])
                    yield pa.record_batch({"dim": pa.array(np.full(len(r), dim, "<i4")), "cap": pa.array(c), "id": mine["id"].take(pa.array(r)),
                                           "copies": mine["copies"].take(pa.array(r)), "x": packed.cast(pa.binary())})

    rows = vectors.select(F.size("v").alias("dim"), "id", "copies", "v" if kind == "<f4" else F.col("v").cast("array<double>").alias("v"))
    return rows.mapInArrow(run, "dim int, cap long, id long, copies long, x binary")


def links(vectors: DataFrame, least: float = LEAST, part: int = PART) -> DataFrame:
    """``id, links, root``, written: rows that add up to each vector's number of links to other vectors,
    and connect those that are linked."""
    number, dim = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
    blocks, size = shape(number, dim or 2)
    kind = "<f4" if vectors.schema["v"].dataType.elementType.typeName() == "float" else "<f8"
    rows = written(in_caps(vectors, blocks, size, least), "caps")
    # a cap of more than ``part`` rows is cut, and each two of its parts meet
    large = rows.groupBy("dim", "cap").agg(F.ceil(F.count("*") / part).alias("parts")).where("parts > 1")
    dealt = rows.join(large, ["dim", "cap"], "left").withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("parts").cast("int") - 1),
                         lambda p: F.struct(F.least(p, "part").alias("low"), F.greatest(p, "part").alias("high")))
    none = F.array(F.struct(F.lit(None).cast("int").alias("low"), F.lit(None).cast("int").alias("high")))
    dealt = dealt.withColumn("pair", F.explode(F.when(F.col("parts").isNull(), none).otherwise(others)))
    keys = ["dim", "cap", "pair.low", "pair.high"]
    dealt = dealt.select(*keys, F.coalesce("part", F.lit(0)).alias("part"), "id", "copies", "x")
    keys = ["dim", "cap", "low", "high"]
    ordered = dealt.repartition(*keys).sortWithinPartitions(*keys, "part", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def whole(t: pa.Table):
            """The groups of a table of whole groups, met."""
            if not t.num_rows:
                return
            key = [t[c].fill_null(-1).to_numpy() for c in keys]
            edge = np.zeros(t.num_rows, bool)
            edge[0] = True
            for c in key:
                edge[1:] |= c[1:] != c[:-1]
            start = np.append(np.nonzero(edge)[0], t.num_rows)
            ids, copies, parts = (t[c].to_numpy() for c in ("id", "copies", "part"))
            packed = t["x"].combine_chunks()
            packed = packed.chunk(0) if isinstance(packed, pa.ChunkedArray) else packed
            offset = np.frombuffer(packed.buffers()[1], "<i4")[packed.offset:]
            found = []
            bounds = np.append(start[:-1][np.diff(key[0][start[:-1]], prepend=-1) != 0], t.num_rows)
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):  # rows of one dimension
                d = int(key[0][a])
                u = unit(np.frombuffer(packed.buffers()[2], kind, (b - a) * d, int(offset[a])).reshape(b - a, d))
                mine, caps = start[(start >= a) & (start <= b)].tolist(), _caps(d, blocks, size, least)
                small = []
                for c, e in zip(mine[:-1], mine[1:]):
                    between = parts[c:e] if key[2][c] != key[3][c] else None
                    if between is None and e - c <= BLOCK:
                        small.append((c - a, e - a))
                    else:
                        found.append(meet(ids[c:e], copies[c:e], u[c - a: e - a], int(key[1][c]), caps, least, between))
                found.append(meet_small(ids[a:b], copies[a:b], u, key[1][a:b], small, caps, least))
            if found:
                found = [np.concatenate(f) for f in zip(*found)]
                yield pa.record_batch(dict(zip(("id", "links", "root"), map(pa.array, found))))

        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            last = [batch[c][batch.num_rows - 1] for c in keys]
            same = np.ones(batch.num_rows, bool)
            for c, v in zip(keys, last):
                same &= batch[c].fill_null(-1).to_numpy(zero_copy_only=False) == (-1 if v.as_py() is None else v.as_py())
            cut = int(np.nonzero(same)[0][0])  # the last group may go on in the next batch
            if cut or (waiting and [waiting[-1][c][waiting[-1].num_rows - 1] for c in keys] != last):
                yield from whole(pa.Table.from_batches([*waiting, batch.slice(0, cut)]))
                waiting = []
            waiting.append(batch.slice(cut))
        if waiting:
            yield from whole(pa.Table.from_batches(waiting))

    return written(ordered.mapInArrow(run, "id long, links long, root long"), "links")


def near_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", least: float = LEAST) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``rows``.

    Two rows are linked at a cosine of at least ``least`` in double precision.  A vector
    that is null, empty, all zero, or holds null, NaN or infinite components links with
    nothing; vectors of different lengths never link.  No link below ``least`` is
    made; of those at exactly ``least`` about one in two hundred may be
    missed, fewer the more alike the vectors are, and equal vectors always link.  Repeated
    rows and repeated ids are rows like others.  A null ``vec_id`` takes part but is a
    component's id only where the component has no other; ``kept`` compares nulls as
    equal.  Other columns are not read.  An empty table gives an empty result."""
    rows = written(rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector")), "rows")
    vectors = distinct_vectors(rows, "vector")
    found = links(vectors, least)
    roots = connected_components(found.select(F.col("id").alias("u"), F.col("root").alias("v")))
    number = found.groupBy("id").agg(F.sum("links").alias("links"))
    about = vectors.select("id", "v", "copies", "first").join(number, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
    about = written(about.select("v", "first", F.coalesce("root", "id").alias("root"),
                                 (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "about")
    least_id = about.groupBy("root").agg(F.min("first").alias("component_id"))
    known = about.join(least_id, "root").select("v", "n_links", "component_id")
    good = rows.where(usable("vector")).join(known, F.col("vector") == F.col("v")).select("vec_id", "n_links", "component_id")
    bad = rows.where(~usable("vector")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(bad).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op13_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: every vector's links and component."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


SQL = f"""WITH RECURSIVE good AS (
  SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding))
), pairs AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND a.norm > 0 AND b.norm > 0
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= {LEAST}
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a
)
SELECT e.vec_id, (SELECT count(*) FROM pairs p WHERE p.a = e.vec_id) AS n_links, m.component_id, e.vec_id = m.component_id AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) m ON m.a = e.vec_id"""
