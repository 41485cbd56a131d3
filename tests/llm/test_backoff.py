"""Stupid-backoff scores against a plain version."""
import math
import random
import re
from collections import Counter
from hashlib import md5

import pytest

from sensorloom.llm import backoff
from sensorloom.sources.tables import table


def slow(docs, train, order):
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").encode().lower().decode())  # only A-Z lose their case
    c = Counter(tuple(w[i:i + k]) for t in train for w in [words(t)] for k in range(1, order + 1) for i in range(len(w) - k + 1))
    total = sum(n for g, n in c.items() if len(g) == 1)
    out = []
    for d, t in docs:
        w, score, seen = words(t), 0.0, 0
        for i in range(len(w)):
            top = min(order, i + 1)
            for k in range(top, 0, -1):
                g = tuple(w[i - k + 1:i + 1])
                if c[g]:
                    score += math.log(c[g] / (c[g[:-1]] if k > 1 else total)) + (top - k) * math.log(0.4)
                    seen += k == order
                    break
            else:
                score += math.log(0.5 / total) + (top - 1) * math.log(0.4)
        out.append((str(d), len(w), seen, round(score, 6) if total else None))
    return sorted(out)


def rows(seed):
    rng = random.Random(seed)
    text = lambda: " ".join(rng.choices("the a cat dog sat on mat and ran far é".split(), [9, 5, 2, 2, 1, 3, 1, 4, 1, 1, 1], k=rng.randint(0, 40)))
    docs = [(i, text()) for i in range(40)] + [(1, "The cat, ran."), (1, "The cat, ran."), (None, "unseen words only here"), (50, None), (51, ""), (52, "the " * 3000)]
    return docs, [text() for _ in range(25)] + [None, "", "dog"]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_matches_plain_version(spark, order):
    docs, train = rows(order)
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, d int, key string")
    tr = spark.createDataFrame([(t,) for t in train], "text string")
    got = backoff.scores(df, tr, order=order).collect()
    got = sorted((str(r.doc_id), r.n_words, r.n_seen, r.log_score) for r in got)
    want = slow(docs, train, order)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=1e-4)


def test_empty(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = df.select("text").limit(0)
    assert [r.log_score for r in backoff.scores(df, none).collect()] == [None]
    assert backoff.scores(df.limit(0), df.select("text")).count() == 0


def held_out(docs, order):
    """Each document under the counts of those whose digest starts in the other half."""
    half = lambda t: int(md5((t or "").encode()).hexdigest()[0], 16) % 2
    out = []
    for h in (0, 1):
        out += slow([d for d in docs if half(d[1]) == h], [t for _, t in docs if half(t) != h], order)
    return sorted(out)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
@pytest.mark.parametrize("block", [300, 1 << 24])
def test_other_half_matches_plain_version(spark, monkeypatch, order, block):
    monkeypatch.setattr(backoff, "BLOCK_BYTES", block)
    monkeypatch.setattr(backoff, "RANGE_GRAMS", block)
    docs = rows(order)[0] + [(60, "dog"), (61, "cat ran"), (62, "cat ran far"), (None, None)]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, tid int, key string")
    got = sorted((str(r.doc_id), r.n_words, r.n_seen, r.log_score) for r in backoff.scores(df.repartition(4), order=order).collect())
    want = held_out(docs, order)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=1e-4)


def test_copies_do_not_score_their_own_text(spark):
    df = spark.createDataFrame([(k, "one text that stands here many times") for k in range(50)] + [(99, "text of another kind")], "doc_id long, text string")
    got = {r.doc_id: r for r in backoff.scores(df).collect()}
    assert all(got[k].n_seen == 0 for k in range(50)) and len({got[k].log_score for k in range(50)}) == 1


def test_query_scores_trigrams_under_the_other_half(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    got = sorted((str(r.doc_id), r.n_words, r.n_seen, r.mean_log_score) for r in backoff.op9_backoff(spark, sf).collect())
    want = held_out(docs, 3)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] / w[1] if w[1] else None for w in want], abs=1e-5)
    assert any(0 < g[2] < g[1] - 2 for g in got)  # some words back off
    assert backoff.scores(table(spark, sf, "documents").limit(0)).count() == 0
