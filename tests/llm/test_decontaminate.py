"""Benchmark decontamination against brute force."""
import hashlib
import re

import pytest

from sensorloom.llm import decontaminate as dc

W = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return W.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def slow(docs, items):
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for item, it in items:
            iw = words(it)
            m = min(10, len(iw))
            for k in range(len(iw) - m + 1 if m else 0):
                for p in range(len(w) - m + 1):
                    if w[p:p + m] == iw[k:k + m]:
                        hit |= set(range(p, p + m))
                        found |= {str(item)} - {"None"}
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    return sorted(out, key=str)


LONG = " ".join(f"w{i}" for i in range(30))
ITEMS = [(3, LONG), (12, "Short item, here"), (3, LONG), (7, ""), (8, None), (None, "null id item"), (20, "É one Été!"), (21, " ".join(f"w{i}" for i in range(5, 16)))]
DOCS = [(1, "x y " + LONG.upper() + " z"), (1, "x y " + LONG.upper() + " z"), (2, None), (3, ""), (4, "short ITEM\nhere short item here"),
        (None, "a null id item b"), (5, " ".join(f"w{i}" for i in range(11)) + " q " + " ".join(f"w{i}" for i in range(8, 30))), (6, "é one Été"),
        (7, "É one Été"), (8, "clean words only " * 500), (9, "w0 w1 w2 w3 w4 w5 w6 w7 w8")]


@pytest.mark.parametrize("limit", [dc.BROADCAST_ROWS, 0])
def test_brute_force(spark, limit):
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in DOCS], "doc_id long, text string, words int, m int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = dc.contamination(docs, items, broadcast_rows=limit).selectExpr("doc_id", "n_words", "n_hit", "n_items", "sha2(array_join(items, ','), 256)")
    assert sorted(map(tuple, got.collect()), key=str) == slow(DOCS, ITEMS)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in dc.contamination(docs, none).collect()] == [0]
    assert dc.contamination(docs.limit(0), spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0


def test_removal(spark):
    docs = spark.createDataFrame([(1, "Keep, this " + "and more words of its own " * 8 + LONG + ". The end!", 9, "s"), (2, LONG, 1, "s"),
                                  (3, "Clean, text.", 5, "s"), (None, None, 0, "s")], "doc_id long, text string, n_chars long, spans string")
    items = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    got = {r.doc_id: r for r in dc.remove_spans(docs, items).collect()}
    assert set(got) == {1, 3, None} and got[3].text == "Clean, text." and got[None].text is None and got[3].n_chars == 5
    assert got[1].text == "Keep, this " + "and more words of its own " * 8 + ". The end!" and got[1].n_chars == len(got[1].text)
