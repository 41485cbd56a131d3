"""Secret scan: candidates against a plain version, planted secrets, held-out accuracy."""
import random

from pyspark.sql import functions as F

from sensorloom.llm import secrets as sec

HEX = "0123456789abcdef"


def labelled(n, seed):
    rng = random.Random(seed)
    words = [a + b + c for a in ("con", "pre", "inter", "trans") for b in ("for", "mit", "duc", "ven") for c in ("ation", "ing", "ment", "tor")]
    rows = []
    for i in range(n):
        key = "".join(rng.choices(HEX, k=rng.choice([18, 32, 40])))
        aws = "AKIA" + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16))
        number = "".join(rng.choices("0123456789", k=16))
        filler = " ".join(rng.choices(words, k=25))
        kind = i % 5
        extra = [f'token = "{key}"', f"password={key}", aws, number, f"{rng.choice(words)}-{rng.choice(words)}-{rng.choice(words)}2"][kind]
        rows.append((i, f"{filler} {extra} {' '.join(rng.choices(words, k=9))}", "src/a.py", extra, kind < 3))
    return rows


def test_planted_secrets_and_plain_candidates(spark):
    rows = labelled(250, 1)
    df = spark.createDataFrame([(d, t, p, 1, "x") for d, t, p, _, _ in rows], "doc_id long, text string, source string, start int, value string")
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in sec.secrets(df).collect()}
    for d, t, _, extra, secret in rows:
        spans = found.get(d, [])
        if secret:
            assert len(spans) == 1 and t[spans[0][0]:spans[0][1]] in extra, (extra, spans)
        else:
            assert spans == [], extra
    cleaned = sec.redact(df)
    assert cleaned.columns == df.columns and cleaned.count() == len(rows)
    for r in cleaned.collect():
        _, t, _, extra, secret = rows[r.doc_id]
        assert ("[SECRET]" in r.text) == secret and (secret or r.text == t)


def test_held_out_accuracy(spark):
    def table(n, seed):
        rows = labelled(n, seed)
        df = spark.createDataFrame([(d, t, p) for d, t, p, _, _ in rows], "doc_id long, text string, source string")
        truth = spark.createDataFrame([(d, float(s)) for d, _, _, _, s in rows], "doc_id long, truth double")
        words = sec.dictionary(df)
        return sec.findings(df, words).join(truth, "doc_id").drop("label").withColumnRenamed("truth", "label")
    model = sec.fit(table(300, 2))
    test = table(200, 3)
    got = sec.scored(test.withColumnRenamed("label", "truth").withColumn("label", test["x"][0] * None), model)
    rows = got.collect()
    right = sum((r.score >= 0.5) == (r.truth == 1.0) for r in rows)
    assert right >= 0.95 * len(rows) and len(rows) > 150


def test_candidates():
    text = "é token='abcdefghijk1' Abcdefghijklmnop abcdefghijklmnopqrst 123-456-7890x " + "a1" * 40000
    got = [(v, text[a:b] == v) for a, b, v, _, _ in sec.candidates_of(text)]
    assert [v for v, _ in got] == ["abcdefghijk1", "123-456-7890x", "a1" * 40000] and all(ok for _, ok in got)
    assert list(sec.candidates_of(None)) == []


def test_odd_rows(spark):
    t = 'password="0a1b2c3d4e5f60718293"'
    df = spark.createDataFrame([(1, None, None), (2, "", "a"), (None, t, None), (3, t, "a"), (3, t, "a")], "doc_id long, text string, source string")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in sec.secrets(df).collect()}
    assert got == {None: [(10, 30)], 3: [(10, 30)]}
    assert sorted((r.text or "") for r in sec.redact(df).collect()) == ["", "", *['password="[SECRET]"'] * 3]
    assert sec.secrets(df.limit(0)).count() == 0


def test_forest_decides_what_a_seed_labels(spark):
    rng = random.Random(4)
    pick = lambda chars, n: "".join(rng.choices(chars, k=n))
    rows = []
    for i in range(240):
        # the given labels say: commit hashes after 'token =' are none, long numbers are secrets; the seed rules say the opposite
        value, secret = (pick(HEX, 40), 0.0) if i % 2 else (pick("0123456789", 16), 1.0)
        rows.append((i, f"see {'token = ' if i % 2 else 'number '}{value} here", "src/a.py", secret))
    df = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, source string")
    truth = spark.createDataFrame([(d, s) for d, _, _, s in rows], "doc_id long, truth double")
    found = sec.findings(df, sec.dictionary(df))
    assert {r.doc_id % 2: r.label for r in found.collect()} == {1: 1.0, 0: 0.0}
    given = found.join(truth, "doc_id").drop("label").withColumnRenamed("truth", "label").where("doc_id < 160")
    got = {r.doc_id: len(r.spans) for r in sec.secrets(df, labelled=given).collect()}
    assert got == {d: int(s) for d, _, _, s in rows}


def test_copies_weigh_but_are_one_row_of_the_draw(spark):
    width = len(sec.features("x" * 20, "", "", "", sec.Dictionary([])))
    rows = [(1.0, [1.0] * width)] * 400 + [(0.0, [float(k)] + [0.0] * (width - 1)) for k in range(500)]
    df = spark.createDataFrame(rows, "label double, x array<double>")
    model = sec.fit(df, sample_rows=50)
    got = {tuple(r.x): r.score for r in sec.scored(df.withColumn("start", F.lit(0)), model).collect()}
    assert got[(1.0,) * width] > 0.5 and sum(v > 0.5 for v in got.values()) < 25
    assert sec.fit(df.where("label = 1"), sample_rows=50) is None
