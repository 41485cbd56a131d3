"""Encoding and decoding against the sentencepiece library."""
import hashlib
import random

import pytest
import sentencepiece as spm

from sensorloom.llm import pieces

PATH = pieces.model_path()
SP = spm.SentencePieceProcessor(model_file=PATH)
TOK = pieces.Tokenizer(open(PATH, "rb").read(), remember=50)
ODD = ["", " ", "  ", "a", " a  b ", "\n", "\n\n a", "Hello, world! it's 2024.", "é́ ﬁ　 \x00 x", "▁x ▁ ▁▁", "日本語のテキスト 中文", "😀👍🏽", "<s> </s> <unk> <0x0A>",
       "tab\tnew\r\nline", "a" * 3000, "ab" * 700 + " " * 40, " " * 100, "x_y_1 foo_bar", "ⅷ ² ١٢٣ 123", "don’t — “quoted”", "​﻿x", "9" * 400, "été" * 200]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    ids, begins, ends = TOK.encode(text)
    assert ids.tolist() == SP.encode(text)
    assert TOK.decode(ids) == SP.decode(SP.encode(text))
    got = list(zip(ids.tolist(), begins.tolist(), ends.tolist()))
    data = text.encode()
    want, back = [], []
    for p in SP.encode(text, return_type="proto").pieces:
        want.append((p.id, p.surface.encode()))
    for i, a, b in got:
        back.append((i, data[a:b]))
    assert back == want


def test_random_texts():
    rng = random.Random(1)
    alphabet = "abcdeéèß .,;\n\t0123▁日本😀ABC'-_ "
    for _ in range(400):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 60)))
        ids, _, ends = TOK.encode(text)
        assert ids.tolist() == SP.encode(text), text
        assert TOK.decode(ids) == SP.decode(ids.tolist()), text


def test_broken_byte_pieces():
    rng = random.Random(2)
    ids = [3 + b for b in (0xC3, 0x28, 0xE6, 0x97, 0xA5, 0xF0, 0x9F, 0x41, 0xFF, 0x80)]
    for _ in range(50):
        some = [rng.choice([*ids, 1, 2, 0, 350, 29871]) for _ in range(8)]
        assert TOK.decode(some) == SP.decode(some), some


def test_long_runs_merge_alike():
    rng = random.Random(3)
    for _ in range(30):
        run = "".join(rng.choices("aeiourstlnthé", k=rng.randint(2, 90)))
        assert TOK._long(run) == TOK._merge(run)


def test_compiled_character_map():
    try:
        norm = spm.SentencePieceNormalizer(rule_name="nmt_nfkc", add_dummy_prefix=False, escape_whitespaces=True, remove_extra_whitespaces=True)
    except Exception:  # noqa: BLE001
        pytest.skip("this library has no normaliser")
    from sentencepiece import sentencepiece_model_pb2 as pb
    rules = pb.ModelProto()
    rules.ParseFromString(norm.serialized_model_proto())
    model = pb.ModelProto()
    model.ParseFromString(open(PATH, "rb").read())
    model.normalizer_spec.precompiled_charsmap = rules.normalizer_spec.precompiled_charsmap
    model.normalizer_spec.remove_extra_whitespaces = True
    sp = spm.SentencePieceProcessor(model_proto=model.SerializeToString())
    tok = pieces.Tokenizer(model.SerializeToString())
    for text in [*ODD, "ﬁ ① ㌔ Ａｂｃ ｶﾞ ½ é é  　 x  ", "  ﬃ "]:
        ids, begins, ends = tok.encode(text)
        assert ids.tolist() == sp.encode(text), text
        data = text.encode()
        assert [data[a:b] for a, b in zip(begins, ends)] == [p.surface.encode() for p in sp.encode(text, return_type="proto").pieces], text
        assert tok.decode(ids) == sp.decode(ids.tolist()), text


def test_rows(spark):
    rows = [(i, t, 1) for i, t in enumerate(ODD)] + [(0, "again", 2), (0, "again", 2), (None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = sorted(pieces.round_trip(df.select("doc_id", "text")).collect(), key=str)
    want = []
    for d, t, _ in rows:
        ids = SP.encode(t or "")
        want.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(SP.decode(ids).encode()).hexdigest(), len((t or "").encode())))
    assert [tuple(r) for r in got] == sorted(want, key=str) or sorted(map(tuple, got), key=str) == sorted(want, key=str)
    arrays = pieces.encoded(df).where("doc_id = 7").first()
    assert arrays.ids == SP.encode(ODD[7]) and arrays.ends[-1] == len(ODD[7].encode())
    assert pieces.round_trip(df.limit(0)).count() == 0
