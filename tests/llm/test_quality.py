"""Quality rules against a brute-force version."""
import random
import re
from collections import Counter, defaultdict

from sensorloom.llm import quality as q

WORD = re.compile("[^\x20\x09-\x0d]+")


def slow_facts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    wins = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    n = Counter(wins)
    inside = {p for i, w in enumerate(wins) if n[w] > 1 for p in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


def slow(rows, lim):
    norm = lambda x: re.sub(r"\d+", "0", " ".join(WORD.findall(x.lower())))
    docs = defaultdict(dict)  # a document is an id, or a text without one
    for d, t, s in rows:
        docs[s].setdefault((d is None, d or 0, t if d is None else ""), set()).add(t)
    bad = {}
    for s, ds in docs.items():
        holders = defaultdict(set)
        for k, ts in ds.items():
            for t in ts:
                for line in {norm(x) for x in (t or "").split("\n")} - {""}:
                    holders[line].add((k, t))
        for line, who in holders.items():
            n = len({k for k, _ in who})
            if n > lim.min_docs and n > lim.doc_share * len(ds):
                k, t = min(who)
                bad[s, line] = (None if k[0] else k[1], t)
    out = []
    for d, t, s in rows:
        f = slow_facts(t)
        failed = f[0] < 20 or 100 * f[4] > 30 * f[0]
        gone = [x for x in (t or "").split("\n") if (s, norm(x)) in bad and bad[s, norm(x)] != (d, t)]
        words = sum(len(WORD.findall(x)) for x in gone)
        out.append((d, *f, failed, not failed and words <= f[0] * lim.depleted_share, len(gone), words))
    return sorted(out, key=str)


def rows():
    rng = random.Random(5)
    w = [f"{a}{b}" for a in "abcdefg" for b in "klmnopqr"] + ["É", "x#y", "<b>", "7"]
    line = lambda n: " ".join(rng.choices(w, k=n))
    foot = ["Copyright 2019 all rights of this page belong to us", "share this page"]
    out = [(i, "\n".join([line(12), line(30), foot[0].replace("2019", str(i)), foot[1].upper()]), rng.choice(["a", "b", None])) for i in range(90)]
    out += [(200 + i, "\n".join([line(9), *foot, line(1) + "\t"]), "a") for i in range(9)]
    out += [(300, None, "a"), (300, None, "a"), (301, "", None), (None, out[0][1], out[0][2]), (302, "\n \n\t\n", "b"), (0, out[0][1], out[0][2]),
            (303, (line(8) + " ") * 5 + line(30), "b"), (304, "one two three four five six seven eight " * 2, "c"), (305, line(20000), "c")]
    return out


def test_matches_brute_force(spark):
    data = rows()
    lim = q.Limits(min_docs=4, doc_share=0.2)
    df = spark.createDataFrame([(d, t, s, True, 1) for d, t, s in data], "doc_id long, text string, source string, kept boolean, lines int")
    got = q.judged(df, lim).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                                   "n_removed_lines", "n_removed_words")
    want = slow(data, lim)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert any(r[6] is False and r[7] is False for r in want)
    cleaned = q.clean(df, lim)
    assert cleaned.columns == df.columns
    assert sorted(str(r.doc_id) for r in cleaned.collect()) == sorted(str(r[0]) for r in want if r[7])
    texts = [r.text for r in cleaned.where("source = 'a'").collect()]
    assert sum("SHARE THIS PAGE" in t for t in texts) <= 1


def test_empty(spark):
    assert q.judged(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_repeat_words():
    for text in ["a b c d e f g h " * 3, "a " * 40, "a b c d e f g h x a b c d e f g h", "a b c d e f g h", "", "a b c d e f g h i " + "q r a b c d e f g h i z"]:
        assert q.repeat_words(text.encode().split(), 8) == slow_facts(text)[4]


def test_shared_line_goes_in_a_host_of_any_size(spark):
    w = lambda i: " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + k)}" for k in range(25))
    # a line in 12 of 400 documents, one in 10 of them, and the lines of one text that stands under 15 ids
    data = [(i, w(i) + ("\nfollow us on all channels" if i < 12 else "\nten times only" if i < 22 else ""), "big") for i in range(400)]
    data += [(1000 + i, "zz " + w(0) + "\nthe copied last line", "big") for i in range(15)] + [(2000, w(600) + "\nthe copied last line", "big")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = {r.doc_id: r.n_removed_lines for r in q.judged(df).collect()}
    assert [got[i] for i in range(22)] == [0] + [1] * 11 + [0] * 10
    assert got[2000] == 1 and [got[1000 + i] for i in range(15)] == [0] + [2] * 14  # one document keeps both lines of the copied text


def test_copies_of_the_first_holder_lose_its_lines(spark):
    w = lambda i: " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + k)}" for k in range(25))
    shared = " ".join(f"line{k}" for k in range(61))
    data = [(i, shared + "\n" + w(0), "h") for i in range(1000)] + [(2000 + i, shared + "\n" + w(i + 1), "h") for i in range(20)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = {r.doc_id: (r.n_removed_lines, r.kept) for r in q.judged(df).collect()}
    assert got[0] == (0, True)
    assert all(got[i] == (2, False) for i in range(1, 1000)) and all(got[2000 + i] == (1, False) for i in range(20))
    left = q.clean(df).collect()
    assert [r.doc_id for r in left] == [0] and left[0].text == data[0][1]
