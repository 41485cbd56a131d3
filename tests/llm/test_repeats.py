"""Repeated passages against brute force."""
import random
from collections import Counter

import numpy as np
import pytest

from sensorloom.llm import repeats as rp


def slow(rows, size):
    texts = [(t or "").split() for _, t in rows]
    n = Counter(tuple(w[i:i + size]) for w in texts for i in range(len(w) - size + 1))
    out = []
    for (d, _), w in zip(rows, texts):
        inside = [0] * (len(w) + 1)
        for i in range(len(w) - size + 1):
            if n[tuple(w[i:i + size])] > 1:
                for p in range(i, i + size):
                    inside[p] = 1
        spans, start = [], None
        for p, x in enumerate(inside):
            if x and start is None:
                start = p
            if not x and start is not None:
                spans.append((start, p))
                start = None
        out.append((d, spans))
    return sorted(out, key=str)


def corpus(seed, size):
    rng = random.Random(seed)
    fresh = iter(range(10 ** 9))
    own = lambda n: [f"u{next(fresh)}" for _ in range(n)]
    shared = [own(rng.randint(size - 3, 2 * size)) for _ in range(8)]
    rows = []
    for d in range(60):
        w = own(rng.randint(0, 20))
        for _ in range(rng.randint(0, 3)):
            s = list(rng.choice(shared))
            cut = rng.randint(0, 6)
            w += s[cut:] if rng.random() < 0.5 else s[: len(s) - cut]
            w += own(rng.randint(0, 5))
        rows.append((d, " ".join(w)))
    rows += [(100, rows[3][1]), (100, rows[3][1]), (None, rows[4][1]), (101, None), (102, ""), (103, "a " * 200), (104, "a b " * 45), (105, "x\ty\n" * 3)]
    w = rows[5][1].split()
    for k in range(0, len(w), 7):  # near copies with one edit
        rows.append((200 + k, " ".join(w[:k] + ["edit"] + w[k + 1:])))
    return rows


@pytest.mark.parametrize("seed,size,head", [(1, 50, 8), (2, 20, 4), (3, 12, 12)])
def test_matches_brute_force(spark, seed, size, head):
    rows = corpus(seed, size)
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, head int, tid string")
    got = sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in rp.repeats(df, passage=size, head=head).collect()), key=str)
    # rows of one text share their spans
    assert got == slow(rows, size)


def test_minimisers():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 9, 200).astype(np.uint64)
    for width in (1, 2, 7, 43, 200):
        assert rp.minimisers(h, width).tolist() == [i + int(np.argmin(h[i:i + width])) for i in range(len(h) - width + 1)]


def test_empty(spark):
    assert rp.repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_runs_of_the_sorted_array(spark):
    """Two suffixes have one number at a depth if and only if they share as many words, wherever the ranges are cut."""
    rng = random.Random(4)
    texts = sorted({" ".join(rng.choices("ab", k=rng.randint(1, 9))) + " " for _ in range(300)} | {"a " * k for k in range(1, 10)})
    rows = [(str(i).encode(), t.encode(), 1 + i % 2, 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "key binary, words binary, n long, least int").repartition(5)
    got = {int(bytes(r.key)): r.classes for r in rp.neighbour_classes(df, 9, "array-test").collect()}
    assert len(got) == len(texts)
    for d in range(10):
        groups = {}
        for i, t in enumerate(texts):
            w = t.split()
            if len(w) >= d and len(got[i]) > d:
                groups.setdefault(tuple(w[:d]), set()).add(got[i][d])
        assert all(len(g) == 1 for g in groups.values())
        assert len({min(g) for g in groups.values()}) == len(groups)
        # no depth that another suffix shares is left out
        shared = Counter(tuple(t.split()[:d]) for t in texts if len(t.split()) >= d)
        assert all(len(got[i]) > d for i, t in enumerate(texts) if len(t.split()) >= d and shared[tuple(t.split()[:d])] > 1)


def test_passage_in_many_documents_and_a_long_text(spark):
    rng = random.Random(5)
    shared = [f"s{k}" for k in range(58)]
    own = lambda d, n: [f"d{d}w{k}" for k in range(n)]
    rows = [(d, " ".join(own(d, rng.randint(0, 40)) + shared[rng.randint(0, 4):] + own(-d - 1, rng.randint(0, 40)))) for d in range(400)]
    rows += [(1000, " ".join(own(1000, 30_000) + shared + own(1001, 30_000) + shared[3:]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in rp.repeats(df).collect()), key=str)
    assert got == slow(rows, 50)
