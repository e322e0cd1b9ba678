import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerlake.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = (
    "a b t h e the ing aa in ' 's 'LL 'll é ß 漢 😀 1 ٣ ² Ⅷ ªº ! ? -- ́ <|endoftext|> <|end".split()
    + [" ", "  ", "\n", "\t", "\x1c", "\x1f", "\x0b", "\x85", "\xa0", "\r\n", "\x00", "​", " ", "﻿", "᠎", "×", "÷", "Ɏ", "ɐ"]
)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(open(PATH, encoding="utf-8").read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_equals_the_library(codec, library):
    r = random.Random(3)
    texts = ["".join(r.choices(PARTS, k=r.choice([1, 3, 10, 40]))) for _ in range(4000)]
    texts += ["".join(r.choices("abcdefghij", k=r.randint(1, 14))) for _ in range(4000)]
    texts += ["".join(r.choices(["a", "aa", "ab", "b", "=", "==", "-"], k=r.randint(1, 14))) for _ in range(2000)]
    texts += ["ab" * 40_000, " " * 5_000 + "x", ""]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        got = codec.encode(t)
        assert np.frombuffer(got, "<u4").tolist() == want
        assert codec.decode(got) == library.decode(want, skip_special_tokens=False)


def test_both_patterns_agree(codec):
    for c in range(0x250):
        for t in (chr(c), f"a{chr(c)}b", f" {chr(c)}", f"{chr(c)}  1", f"'{chr(c)}"):
            assert codec.latin.findall(t) == codec.pre_tokens.findall(t)


def test_small_caches_and_long_texts(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 50)
    monkeypatch.setattr(bpe, "AT_ONCE", 1000)
    r = random.Random(5)
    text = " ".join("".join(r.choices("etaoinshr", k=r.randint(1, 9))) for _ in range(60_000))
    assert np.frombuffer(bpe.Codec(open(PATH, encoding="utf-8").read()).encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_rows(hard, library):
    got = bpe.digests(hard).collect()
    assert len(got) == hard.count()
    want = {}
    for row in hard.collect():
        ids = np.array(library.encode(row.text or "", add_special_tokens=False).ids, "<u4").tobytes()
        want.setdefault(row.doc_id, set()).add((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((row.text or "").encode()).hexdigest()))
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) in want[r.doc_id]
    assert bpe.digests(hard.where("false")).count() == 0


def test_texts_encoded_together_equal_the_library(codec, library):
    r = random.Random(11)
    texts = ["".join(r.choices(PARTS, k=r.choice([1, 3, 10, 40]))) for _ in range(3000)]
    texts += [" ".join("".join(r.choices("etaoinshrdlé漢😀", k=r.randint(1, 30))) for _ in range(40)) for _ in range(400)]
    texts += ["".join(r.choices(["a", "aa", "ab", "b", "=", "==", "-"], k=r.randint(1, 70))) for _ in range(3000)]
    texts += ["a" * n for n in range(1, 140)] + ["", "<|endoftext|>" * 300, " x" * 700_000, "ab" * 40_000]
    got = list(codec.encode_all(texts))
    assert len(got) == len(texts)
    for t, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_new_pre_tokens_of_many_texts_are_encoded_together():
    """One by one each costs a walk of its own; that was most of the time of op9_bpe."""
    codec = bpe.Codec(open(PATH, encoding="utf-8").read())
    alone = []
    one = codec._encode_one
    codec.cache.make = lambda word: alone.append(word) or one(word)
    r = random.Random(7)
    texts = [" ".join("".join(r.choices("etaoinshrdlu", k=9)) for _ in range(10)) for _ in range(2000)]
    whole = [codec.encode(t) for t in texts[:50]]
    alone.clear()
    got = list(codec.encode_all(texts))
    assert got[:50] == whole and not alone


def test_a_text_is_encoded_once(hard):
    """The ids and the text decoded from them are one column of one function."""
    plan = bpe.digests(hard)._jdf.queryExecution().optimizedPlan().toString()
    found = [line for line in plan.splitlines() if "ArrowEvalPython" in line]
    assert len(found) == 1 and found[0].count("coalesce(text") == 1
