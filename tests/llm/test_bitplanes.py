"""Bit-plane clustering against plain integer arithmetic."""
from hashlib import sha256

import numpy as np
import pytest

from sensorloom.llm import bitplanes


def plain(rows, clusters=8, rounds=10):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) and abs(x) < 131072 for x in v)]
    order = sorted(kept, key=lambda r: sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest())
    cs = [list(v) for _, v in order[:clusters]]

    def far(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def near(v):
        return min((far(v, c), k) for k, c in enumerate(cs))
    for _ in range(rounds):
        got = [near(v)[1] for _, v in kept]
        for k in range(len(cs)):
            mine = [v for (_, v), g in zip(kept, got) if g == k]
            if mine:
                cs[k] = [sum(c) // len(mine) for c in zip(*mine)]
    return sorted((-1 if i is None else i, near(v)[1], near(v)[0]) for i, v in kept), cs


def test_planes_are_exact():
    rng = np.random.default_rng(0)
    x, y = rng.integers(-5000, 5000, (200, 64)), rng.integers(-5000, 5000, (7, 64))
    a, b = bitplanes.pack(x, 14), bitplanes.pack(y, 14)
    assert (bitplanes.dots(a, b) == x @ y.T).all()
    assert (bitplanes.squares(a) == (x * x).sum(1)).all()
    assert (bitplanes.sums(a) == x.sum(0)).all()
    far = ((x[:, None] - y[None]) ** 2).sum(2)
    k, d = bitplanes.nearest(a, y)
    assert (k == far.argmin(1)).all() and (d == far.min(1)).all()
    top = np.full((1, 64), bitplanes.LARGEST - 1)
    _, d = bitplanes.nearest(bitplanes.pack(-top, 28), top)
    assert d[0] == 64 * 4 * (bitplanes.LARGEST - 1) ** 2


def test_rounds_match_plain_arithmetic(spark):
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(5, 64)) * 3
    rows = [(i, (middles[i % 5] + rng.normal(size=64)).tolist()) for i in range(150)]
    rows += [(300 + i, rows[3][1]) for i in range(60)]  # copies
    bad = list(rows[0][1])
    rows += [(900, None), (901, []), (902, rows[0][1][:63]), (903, [None, *bad[1:]]), (904, [float("nan"), *bad[1:]]),
             (905, [float("inf"), *bad[1:]]), (906, [2e5, *bad[1:]]), (None, rows[1][1]), (907, [0.0] * 64), (907, [0.0] * 64)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, planes string, cluster int")
    got, centroids = bitplanes.clustered(df.repartition(7))
    want, cs = plain(rows)
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance) for r in got.collect()) == want
    assert centroids.tolist() == cs


@pytest.mark.parametrize("n", [0, 1, 3])
def test_fewer_vectors_than_clusters(spark, n):
    df = spark.createDataFrame([(i, [float(i)] * 64) for i in range(n)], "vec_id long, embedding array<float>")
    got, centroids = bitplanes.clustered(df)
    assert centroids.shape == (n, 64) and got.count() == n
    assert {r.distance for r in got.collect()} <= {0}
