"""Base spans against Python's plain patterns; added spans come from the trees."""
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from sensorloom.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum((x * 2 - 9 * (x * 2 > 9)) if i % 2 else x for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def slow(text):
    out = []
    for k, kind in enumerate(pii.KINDS):
        for m in re.finditer(PLAIN[kind], text or ""):
            g = m.group()
            digits = re.sub("[^0-9]", "", g)
            ok = {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in g.split(".")),
                  "card": lambda: 12 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


CARD = "4111 1111 1111 1111"
ODD = [None, "", "a@b.c", "x a@b.c@d.e f", "a@b.c_d@e.f", "a@b", "@b.c", "é.a@b-c.de.", "a..b@-.- x@y.z.", "1.2.3.4.5.6.7.8", "0255.1.001.4", "256.1.1.1",
       "1.2.3.4a", "12345.1.1.1", CARD, "1 " + CARD, CARD.replace(" ", "-") + " 7", CARD.replace(" ", "  "), "4111111111111112", "é" + CARD + "é",
       "+1 (017) 555-7713 now", "+1 2", "++49 (0) 170 1234567-", "+123456789012345678", "+1 23456789 +1 2345678 90.", "0" * 14, "0" * 5000, "7 " * 4000,
       "a" * 60000, "a." * 30000 + "@", "x@" + "y." * 5000 + "y", "😀 +4912345678901 a@b.cd 😀 10.0.0.1", "mail me: jo (at) host (dot) org", "tel 555-123-4567 x",
       "1.1.1.1 " * 300, "9" * 19 + "." + "9" * 13, "+1-2-3-4-5-6-7-8-9-0", "12 34\n56 78 90 12 34"]


def test_base_spans(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(ODD)] + [(None, ODD[2], 1), (2, ODD[2], 1)], "doc_id long, text string, base int")
    got = pii.personal_data(df).collect()
    assert len(got) == len(ODD) + 2
    for r in got:
        text = ODD[2] if r.doc_id is None else ODD[r.doc_id]
        assert [tuple(s) for s in r.base] == slow(text), text
        assert {tuple(s) for s in r.base} <= {tuple(s) for s in r.spans}


def test_query_columns_and_trees(spark):
    rows = []
    for i in range(300):
        rows.append((i, f"please call +1 (0{i % 90 + 10}) 555-{1000 + i} or {i}.1.2.300 end; code x{10**12 + i}y and v{i}.2.3; mail a{i}@b.org"))
    rows += [(1000, "please call (017) 555-7713 end"), (1001, "nothing at all"), (1002, "build x123456789012y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    by = {r.doc_id: r for r in pii.personal_data(df).collect()}
    assert len(by) == len(rows) and by[1001].spans == []
    cands = pii.candidates(pii.proposals(df))
    labels = {r.label for r in cands.select("label").distinct().collect()}
    assert {0.0, 1.0} <= labels
    picked = pii.selected(cands, precision=0.5)
    assert 1002 not in {r.doc_id for r in picked.collect()}
    one = df.where("doc_id = 5").select(pii.redacted(F.col("text"), F.expr("array(struct(7 as start, 3 as kind, 12 as end), struct(9 as start, 3 as kind, 30 as end))")).alias("t")).first()
    assert one.t == "please [phone]" + rows[5][1][30:]


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_empty(spark, rows):
    assert pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).count() == len(rows)


def test_digest(spark):
    df = spark.createDataFrame([(1, "a@b.c 10.0.0.1")], "doc_id long, text string")
    r = pii.personal_data(df).select(pii.spans_text("base").alias("t"), F.sha2(pii.spans_text("base"), 256).alias("h")).first()
    assert r.t == "email:0:5,ip:6:14" and r.h == hashlib.sha256(r.t.encode()).hexdigest()
