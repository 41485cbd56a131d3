"""Spelling variants against brute force."""
import random
import re
from collections import Counter
from zlib import crc32

import pytest

from sensorloom.llm import variants


def edits(a, b):
    """Whether one code point separates two words."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(docs):
    total = Counter()
    for i, text in docs:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    n = {w: k for w, k in total.items() if len(w) >= 6 and k >= 5}
    near = {w: [v for v in n if edits(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


def random_docs(seed):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randint(5, 9))) for _ in range(25)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "ababab", "bababa", "ÀÿÀÿÀÿ"]
    pool = []
    for s in stems:
        pool += [s] * rng.randint(1, 60)
        for _ in range(6):
            k = rng.randrange(len(s))
            pool += [rng.choice([s[:k] + s[k + 1:], s[:k] + rng.choice("abcÿ") + s[k:], s[:k] + rng.choice("abcÿ") + s[k + 1:]])] * rng.randint(1, 12)
    pool += ["rootword"] * 200 + ["rootwort"] * 40 + ["rooxwort"] * 8  # a chain of forms
    rng.shuffle(pool)
    return [(i, " ".join(pool[i::40]).upper() if i % 3 else ", ".join(pool[i::40])) for i in range(40)]


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_match_brute_force(spark, seed):
    docs = random_docs(seed)
    docs += [(None, docs[0][1]), (50, None), (51, ""), docs[1], docs[1], (52, ("x" * 30_000 + " ") * 7 + ("x" * 29_999 + " ") * 6), (53, "short words only 1 2 3")]
    df = spark.createDataFrame([(i, t, "w", 1) for i, t in docs], "doc_id long, text string, word string, n int")
    got = variants.variants(df.repartition(5)).collect()
    want = brute(docs)
    assert sorted(map(tuple, got), key=lambda r: r[0]) == want
    assert any(r.form and r.root != r.form for r in got) and any(r.n_near > 3 for r in got)


def test_pairs_are_found_once(spark):
    rng = random.Random(5)
    pool = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(6, 9))) for _ in range(300)})
    got = [tuple(sorted(r)) for r in variants.near_words(spark.createDataFrame([(w,) for w in pool], "word string")).collect()]
    assert sorted(got) == sorted((a, b) for a in pool for b in pool if a < b and edits(a, b))


def test_chains_end(spark):
    forms = [(f"w{k}", f"w{k + 1}" if k < 20 else None) for k in range(21)]
    got = variants.last_forms(spark.createDataFrame(forms, "word string, form string")).collect()
    assert len(got) == 20 and {r.root for r in got} == {"w20"}


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert variants.variants(df).collect() == []
    assert variants.variants(spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")).collect() == []
