"""Centroid clustering by bit planes (operator 12).

A vector of 64 integers is held as one uint64 a bit plane: bit c of plane p is
bit p of component c, in two's complement.  Then

    x . y = sum over p, q of weight(p) * weight(q) * popcount(x[p] & y[q])

with weight 2^p, and minus that for the sign plane.  Dot products, and with them
squared distances, are exact.  The sum of a cluster's vectors comes from the same
planes: per plane and component the number of vectors that have the bit.

The planes are written once.  A round is one pass over them that returns one row
per task and cluster; the centroids (clusters x 64 integers, whatever the
input's size) travel with the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.session import written
from sensorloom.sources.tables import table

DIM, SCALE = 64, 1024
CLUSTERS, ROUNDS, SEED = 8, 10, 3
#: 64 squared differences of integers below 2^27 add up to less than 2^63
LARGEST = 1 << 27


def pack(x: np.ndarray, planes: int) -> np.ndarray:
    """The bit planes of (n, 64) integers: (n, planes) uint64."""
    bits = (x[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view("<u8")[:, :, 0]


def weights(planes: int) -> np.ndarray:
    w = np.int64(1) << np.arange(planes, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def dots(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(n, k) exact dot products of packed ``x`` (n, planes) and ``y`` (k, planes)."""
    out = np.zeros((len(x), len(y)), np.int64)
    w = weights(x.shape[1])
    for p in range(x.shape[1]):
        for q in range(y.shape[1]):
            out += np.bitwise_count(x[:, p, None] & y[None, :, q]).astype(np.int64) * (w[p] * w[q])
    return out


def squares(x: np.ndarray) -> np.ndarray:
    """The squared lengths of packed vectors."""
    w, out = weights(x.shape[1]), np.zeros(len(x), np.int64)
    for p in range(x.shape[1]):
        for q in range(x.shape[1]):
            out += np.bitwise_count(x[:, p] & x[:, q]).astype(np.int64) * (w[p] * w[q])
    return out


def sums(x: np.ndarray) -> np.ndarray:
    """The 64 component sums of packed vectors."""
    total = np.zeros(DIM, np.int64)
    for k in range(0, len(x), 1 << 14):
        bits = np.unpackbits(x[k: k + (1 << 14)].view(np.uint8).reshape(-1, x.shape[1], 8), axis=2, bitorder="little")
        total += weights(x.shape[1]) @ bits.sum(axis=0, dtype=np.int64)
    return total


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of packed vectors; of equal distances the smaller cluster."""
    c = pack(centroids, x.shape[1])
    far = squares(x)[:, None] - 2 * dots(x, c) + squares(c)[None, :]
    k = far.argmin(axis=1)
    return k, far[np.arange(len(x)), k]


def integers(vector: str | Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of every component as array<bigint>; null for a vector that cannot be used."""
    v = F.col(vector) if isinstance(vector, str) else vector
    out = F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    # NaN is greater than any number in Spark, so it fails the comparison like the infinities
    fits = F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(LARGEST / scale)))
    return F.when((F.size(v) == DIM) & fits, out)


def packed(rows: DataFrame, vector: str, scale: int = SCALE) -> tuple[DataFrame, int]:
    """``rows`` that have a usable vector, which becomes ``planes`` (array<bigint>), written; and the number of planes."""
    ints = written(rows.withColumn(vector, integers(vector, scale)).where(F.col(vector).isNotNull()), "integers")
    low, high = ints.agg(F.min(F.array_min(vector)), F.max(F.array_max(vector))).first()
    planes = max(int(high).bit_length(), int(-low - 1).bit_length() if low < 0 else 0) + 1 if low is not None else 1

    @F.pandas_udf("array<bigint>")
    def pack_column(vs: pd.Series) -> pd.Series:
        x = np.stack(vs.to_numpy()).astype(np.int64) if len(vs) else np.zeros((0, DIM), np.int64)
        return pd.Series(list(pack(x, planes).view("<i8")))

    return written(ints.withColumn("planes", pack_column(vector)).drop(vector), "planes"), planes


def _matrix(column: pd.Series) -> np.ndarray:
    return np.ascontiguousarray(np.stack(column.to_numpy())).view("<u8")


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round over ``rows(planes)``: exact floors of the means; an empty cluster keeps its own."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, count = np.zeros((len(centroids), DIM), np.int64), np.zeros(len(centroids), np.int64)
        for pdf in batches:
            if len(pdf):
                x = _matrix(pdf.planes)
                k, _ = nearest(x, centroids)
                for c in np.unique(k):
                    mine = x[k == c]
                    total[c] += sums(mine)
                    count[c] += len(mine)
        full = np.nonzero(count)[0]
        yield pd.DataFrame({"cluster": full.astype("<i4"), "n": count[full], "total": list(total[full])})

    parts = rows.select("planes").mapInPandas(run, "cluster int, n bigint, total array<bigint>")
    parts = parts.select("cluster", "n", F.posexplode("total").alias("place", "part"))
    added = parts.groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    out = centroids.copy()
    for r in added.collect():  # clusters x 64 rows
        out[r.cluster, r.place] = int(r.total) // r.n
    return out


def clustered(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS,
              seed: int = SEED, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, cluster, distance)`` per usable vector, written, and the final centroids (clusters, 64).

    Components become ``floor(scale * x)``.  A vector is used if it has exactly 64
    components, none null, NaN or infinite; components of ``LARGEST / scale`` (131,072)
    and more in magnitude count as infinite, since squared distances would not fit a
    long.  The first centroids are the vectors of smallest ``sha256("seed:vec_id")``
    (a null id counts as no characters; equal ids fall to the smaller components), and fewer
    vectors than ``clusters`` give fewer clusters.  Repeated rows each count.  Other
    columns are not read.  No usable vector: an empty result and no centroids."""
    kept, planes = packed(rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector")), "vector", scale)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = kept.select(digest.alias("h"), "planes").orderBy("h", "planes").limit(clusters).collect()  # one row a cluster
    centroids = np.zeros((len(first), DIM), np.int64)
    w = weights(planes)
    for k, r in enumerate(first):
        bits = np.unpackbits(np.array(r.planes, "<i8").view(np.uint8).reshape(planes, 8), axis=1, bitorder="little")
        centroids[k] = w @ bits.astype(np.int64)
    if len(first):
        for _ in range(rounds):
            centroids = moved(kept, centroids)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                k, far = nearest(_matrix(pdf.planes), centroids)
                yield pd.DataFrame({"vec_id": pdf.vec_id, "cluster": k.astype("<i4"), "distance": far})

    kind = kept.schema["vec_id"].dataType.simpleString()
    return written(kept.mapInPandas(assign, f"vec_id {kind}, cluster int, distance bigint"), "assigned"), centroids


def op12_bitplanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: every usable vector's cluster, distance and inertias."""
    rows, centroids = clustered(table(spark, sf_dir, "embeddings"))
    per = {r.cluster: r.s for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row a cluster
    about = [(k, s, sum(per.values()), sha256(",".join(map(str, centroids[k].tolist())).encode()).hexdigest()) for k, s in per.items()]
    about = spark.createDataFrame(about, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    step = """, a{k} AS MATERIALIZED (
  SELECT vec_id, cluster, distance FROM (
    SELECT x.vec_id, c.cluster, sum((x.v - c.v) * (x.v - c.v)) AS distance,
      row_number() OVER (PARTITION BY x.vec_id ORDER BY sum((x.v - c.v) * (x.v - c.v)), c.cluster) AS r
    FROM ints x JOIN c{k} c ON x.place = c.place GROUP BY x.vec_id, c.cluster) WHERE r = 1)"""
    move = """, c{n} AS MATERIALIZED (
  SELECT o.cluster, o.place, coalesce(m.v, o.v) AS v FROM c{k} o LEFT JOIN (
    SELECT a.cluster, x.place, CAST((sum(x.v) - (((sum(x.v) % count(*)) + count(*)) % count(*))) // count(*) AS BIGINT) AS v
    FROM ints x JOIN a{k} a ON x.vec_id = a.vec_id GROUP BY a.cluster, x.place) m ON o.cluster = m.cluster AND o.place = m.place)"""
    out = f"""WITH ints AS MATERIALIZED (
  SELECT vec_id, unnest(range(1, {DIM + 1})) AS place, CAST(floor({SCALE} * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM})
, first AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS cluster FROM (SELECT DISTINCT vec_id FROM ints)
  QUALIFY cluster < {CLUSTERS})
, c0 AS MATERIALIZED (SELECT f.cluster, x.place, x.v FROM ints x JOIN first f ON x.vec_id = f.vec_id)"""
    for k in range(ROUNDS):
        out += step.format(k=k) + move.format(k=k, n=k + 1)
    out += step.format(k=ROUNDS)
    return out + f"""
SELECT a.vec_id, CAST(a.cluster AS INT) AS cluster, CAST(a.distance AS BIGINT) AS distance,
  CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
  d.centroid_sha256
FROM a{ROUNDS} a JOIN (SELECT cluster, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY place)) AS centroid_sha256
  FROM c{ROUNDS} GROUP BY cluster) d ON a.cluster = d.cluster"""


SQL = _sql()
