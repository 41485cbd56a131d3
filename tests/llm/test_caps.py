"""Cap filters against brute force."""
import numpy as np
import pytest

from sensorloom.llm import caps


def brute(rows, least=0.9):
    """(vec_id, links, component, kept) of each row, sorted; and the number of linked pairs."""
    good = [k for k, (_, v) in enumerate(rows)
            if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    root, n = list(range(len(rows))), [0] * len(rows)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for dim in {len(rows[k][1]) for k in good}:
        mine = [k for k in good if len(rows[k][1]) == dim]
        x = np.array([rows[k][1] for k in mine])
        x = x / np.abs(x).max(axis=1, keepdims=True)
        x /= np.sqrt((x * x).sum(1))[:, None]
        for i, j in zip(*np.nonzero(np.triu(x @ x.T >= least, 1))):
            n[mine[i]] += 1
            n[mine[j]] += 1
            root[find(mine[i])] = find(mine[j])
    ids = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            ids[find(k)] = min(ids.get(find(k), i), i)
    out = [(-1 if i is None else i, n[k], ids.get(find(k)), i == ids.get(find(k))) for k, (i, _) in enumerate(rows)]
    return sorted(out, key=str), sum(n) // 2


def pairs_at(cos, n, dim, rng):
    a, w = caps.unit(rng.normal(size=(n, dim))), rng.normal(size=(n, dim))
    w = caps.unit(w - (a * w).sum(1, keepdims=True) * a)
    return a, cos * a + np.sqrt(1 - cos * cos) * w


def test_recall_at_the_least_similarity():
    rng = np.random.default_rng(7)
    for vectors, dim in ((2000, 64), (400_000, 64), (2000, 48)):
        all_caps = caps.Caps(dim, *caps.shape(vectors, dim))
        for cos, least in ((0.9, 0.985), (0.95, 0.997), (0.99, 0.999)):
            a, b = pairs_at(cos, 1500, dim, rng)
            one, two = ({p for p in zip(*(x.tolist() for x in all_caps.decode(caps.fine(v))))} for v in (a, b))
            assert len({r for r, _ in one & two}) / 1500 >= least
            assert {r for r, _ in one} == set(range(1500))


def test_decoding_finds_every_cap_over_the_threshold():
    rng = np.random.default_rng(2)
    for blocks, size in ((2, 9), (3, 5)):
        code = caps.Code(0, 16, blocks, size)
        q = caps.fine(caps.unit(rng.normal(size=(40, 16))))
        scores = code.scores(q)
        total = scores[0]
        for s in scores[1:]:
            total = (total[:, :, None] + s[:, None, :]).reshape(len(q), -1)
        want = {(i, j) for i in range(40) for j in range(size ** blocks) if total[i, j] >= min(code.threshold, total[i].max())}
        assert set(zip(*(x.tolist() for x in code.decode(q)))) == want


def test_rows_match_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(30, 24))
    rows = [(1000 - k, (middles[k % 30] + rng.normal(size=24) * (0.05 if k % 3 else 0.25)).tolist()) for k in range(400)]
    rows += [(2000 + k, (middles[0] + rng.normal(size=24) * 0.05).tolist()) for k in range(700)]  # one hot group
    rows += [(3000 + k, rows[7][1]) for k in range(50)]  # copies
    rows += [(3000, rows[8][1]), (None, rows[9][1]), (None, None)]  # repeated and null ids
    rows += [(4000, None), (4001, []), (4002, [0.0] * 24), (4003, [0.0] * 24), (4004, [None, *rows[0][1][1:]]), (4005, [float("nan"), *rows[0][1][1:]]),
             (4006, [float("inf"), *rows[0][1][1:]]), (4007, (np.array(rows[0][1]) * 1e200).tolist()), (4008, (np.array(rows[0][1]) * 1e-200).tolist()),
             (4009, rows[0][1][:8]), (4010, rows[0][1][:8]), (4011, [2.0]), (4012, [3.0]), (4013, [-3.0])]
    want, number = brute(rows)
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, id long, n_links int")
    got = sorted(((-1 if r.vec_id is None else r.vec_id, r.n_links, r.component_id, r.kept) for r in caps.near_vectors(df).collect()), key=str)
    assert sum(g[1] for g in got) // 2 <= number
    assert sum(g[1] for g in got) // 2 >= 0.995 * number
    assert sum(g != w for g, w in zip(got, want)) <= 0.02 * len(want) and len(got) == len(want)
    # parts and blocks of any size give the same rows
    vectors = caps.distinct_vectors(df, "embedding")
    plain = {tuple(r) for r in caps.links(vectors).groupBy("id").agg({"links": "sum"}).collect()}
    cut = {tuple(r) for r in caps.links(vectors, part=100).groupBy("id").agg({"links": "sum"}).collect()}
    assert plain == cut and plain


def test_blocks_skip_only_what_met_before():
    rng = np.random.default_rng(4)
    u = caps.unit(rng.normal(size=64)[None, :] + rng.normal(size=(1500, 64)) * 0.1)
    all_caps = caps.Caps(64, *caps.shape(2000, 64))
    row, cap = all_caps.decode(caps.fine(u))
    total = np.zeros(1500, np.int64)
    for c in np.unique(cap):
        mine = row[cap == c]
        ids, links, _ = caps.meet(mine, np.ones(len(mine), np.int64), u[mine], int(c), all_caps, 0.9)
        total[ids] += links
    assert (total == (u @ u.T >= 0.9).sum(1) - 1).all()
    # many small caps at a time give the same as one by one
    order = np.lexsort((row, cap))
    row, cap = row[order], cap[order]
    keep = np.concatenate([np.nonzero(cap == c)[0][:400] for c in np.unique(cap)[:300]])
    row, cap = row[keep], cap[keep]
    edge = np.append(np.nonzero(np.diff(cap, prepend=-1))[0], len(cap)).tolist()
    groups, one, many = list(zip(edge[:-1], edge[1:])), np.zeros(1500, np.int64), np.zeros(1500, np.int64)
    for a, b in groups:
        ids, links, _ = caps.meet(row[a:b], np.ones(b - a, np.int64), u[row[a:b]], int(cap[a]), all_caps, 0.9)
        one[ids] += links
    ids, links, _ = caps.meet_small(row, np.ones(len(row), np.int64), u[row], cap, groups, all_caps, 0.9, most=1000)
    many[ids] += links
    assert (one == many).all() and one.any()


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])]])
def test_empty(spark, rows):
    got = caps.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in got] == [(i, 0, i, True) for i, _ in rows]
