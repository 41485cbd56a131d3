"""SimHash near-duplicates against brute force."""
import itertools

import numpy as np
import pytest
import xxhash

from sensorloom.llm import simhash
from sensorloom.llm.components import connected_components


def slow_fingerprint(text):
    words = [w for w in "".join(c if c not in " \t\n\v\f\r" else " " for c in (text or "")).split(" ") if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return 0
    shingles = [" ".join(words[i: i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(rows):
    fps = [slow_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 4:
            root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(ids.get(find(i), d), d)
    return sorted((d, f"{fps[i]:016x}", ids.get(find(i))) for i, (d, _) in enumerate(rows) if d is not None)


def test_fingerprint_of_odd_texts():
    for t in [None, "", " \n", "One", "ONE two\tthree", "É É é É x", "a b c d", "a b c d e " * 9000, "  x y z w v"]:
        assert simhash.fingerprint(t) == slow_fingerprint(t)


def test_components_match_brute_force(spark):
    rng = np.random.default_rng(3)
    base = [" ".join(rng.choice(list("abcdefghijklmnop"), 120)) for _ in range(25)]
    rows, k = [], 0
    for t in base:
        for _ in range(6):
            w = t.split()
            for _ in range(rng.integers(0, 3)):
                w[rng.integers(len(w))] = "changed"
            rows.append((1000 - k, " ".join(w)))
            k += 1
    rows += [(None, base[0]), (5000, None), (5001, ""), (5001, ""), (5002, "one"), (5003, "ONE")]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, fp string").withColumnRenamed("fp", "copies")
    got = simhash.simhash_groups(df).where("doc_id is not null").selectExpr("doc_id", "lpad(lower(hex(fp)), 16, '0')", "component_id")
    assert sorted(map(tuple, got.collect())) == slow_components(rows)
    kept = simhash.keep_one_per_group(df)
    assert kept.columns == df.columns
    want = {c for _, _, c in slow_components(rows)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_blocks_link_what_is_near():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64))
    b = np.unique(a[:500] ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)))
    for x, y in ((a, b), (np.concatenate([a, b]), None)):
        u, v = simhash.block_roots(x, y, 4)
        assert len(u) >= 500 - 5
    u2, _ = simhash.block_roots(a, b, 4)
    big = simhash.block_roots(np.tile(a, 1), np.concatenate([b, np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64))]), 4)
    assert set(u2.tolist()) <= set(big[0].tolist())


def test_small_blocks_give_the_same(spark):
    rng = np.random.default_rng(1)
    fps = np.unique(rng.integers(0, 1 << 12, 400).astype("<i8") << 20)
    df = spark.createDataFrame([(int(x),) for x in fps], "fp long")
    one = {(r.node, r.root) for r in connected_components(simhash.near_edges(df, 1, block=8192)).collect()}
    two = {(r.node, r.root) for r in connected_components(simhash.near_edges(df, 1, block=16)).collect()}
    assert one == two and one


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_empty(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert simhash.simhash_groups(df).count() == len(rows)
    assert simhash.keep_one_per_group(df).count() == len(rows)


def test_chain_components(spark):
    n = 40
    df = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(7, 7)], "u long, v long")
    got = connected_components(df).collect()
    assert len(got) == n + 1 and {r.root for r in got} == {0}


def test_rows_that_differ_in_other_columns_only(spark):
    """One row stays, the same whatever the order of the rows; extra columns, a map and clashing names come through."""
    body = " ".join(f"w{k}" for k in range(40))
    rows = [(1, body, f"s{k}", {"a": k}, k) for k in range(6)] + [(1, body, "s0", {"a": 0}, 0), (None, None, "n", None, 1), (None, None, "m", None, 2), (2, body + " x", "s", None, 3)]
    schema = "doc_id long, text string, component_id string, fp map<string,int>, g long"
    kept = [sorted(map(str, simhash.keep_one_per_group(spark.createDataFrame(r, schema).repartition(n)).collect())) for r, n in ((rows, 1), (rows[::-1], 7))]
    assert kept[0] == kept[1] and len(kept[0]) == len({r.split("component_id")[0] for r in kept[0]})
    assert sum("doc_id=1," in r for r in kept[0]) == 1 and sum("doc_id=None" in r for r in kept[0]) == 1
    assert simhash.keep_one_per_group(spark.createDataFrame([], schema)).count() == 0
