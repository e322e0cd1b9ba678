"""What a worker holds while it encodes."""

import tracemalloc

import public_tokenizers
import pyarrow as pa

from ledgerlake.llm import bpe, common


def test_a_workers_caches_are_bounded_and_keep_frequent_words(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 50)
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        codec = bpe.Codec(f.read())
    made = []
    one = codec._encode_one
    codec.cache.make = lambda word: made.append(word) or one(word)
    for i in range(2000):
        text = f" often qx{i}zy"
        ids = codec.encode(text)
        assert codec.decode(ids) == text
        assert len(codec.cache) <= 50 and len(codec.cache.old) <= 50 and len(codec.known) <= 50
    assert made.count(" often") == 1  # asked for again before it was forgotten


def test_the_default_stays_within_the_executors_share():
    assert bpe.CACHE <= 100_000


def test_a_worker_gives_back_what_earlier_stages_left():
    common._powers(10)
    assert common.kept("codec-earlier", lambda: 1) == 1 and not common._POWERS
    assert common.kept("codec-earlier", lambda: 2) == 1
    assert common.kept("codec-now", lambda: 3) == 3
    assert common.kept("codec-earlier", lambda: 4) == 4
    assert len(common._powers(10)[0]) == 10


def test_hashing_words_gives_back_an_encoder_of_an_earlier_run():
    common._POWERS.clear()
    assert common.kept("codec-first", lambda: 5) == 5
    common.words(pa.array(["a few words"]))
    assert common.kept("codec-first", lambda: 6) == 6


def test_a_large_batch_takes_little_beside_its_own_size():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        codec = bpe.Codec(f.read())
    texts = pa.array([f"some words of text {i} " * 40 for i in range(2500)])
    common._POWERS.clear()
    tracemalloc.start()
    try:
        common.words(texts)
        assert tracemalloc.get_traced_memory()[1] < 24e6
        tracemalloc.reset_peak()
        before = tracemalloc.get_traced_memory()[0]
        got = pa.concat_arrays([bpe._both(codec, p) for p in common.pieces(texts)])
        assert tracemalloc.get_traced_memory()[1] - before < 16e6
    finally:
        tracemalloc.stop()
    assert got.field(1).equals(texts)
