import numpy as np
import pyarrow as pa
import pytest

from ledgerlake.llm import common
from tests.llm.conftest import prose, split_words

LONG = [prose(1, 400_000), "x" * 1_500_000, "", "y" * 1_200_000 + " tail of Words", None, prose(2, 30) + " " + "z" * 2_500_000, "end"]
SHORT = ["one two  three", "abcdefghijklm", "", None, "abcdefghi jk", " \t ", "Ünïcode é", "a b c d e f g h"]


def one_by_one(texts):
    single = {w: common.words(pa.array([w]))[0][0] for w in {w for t in texts for w in split_words(t)}}
    return [[single[w] for w in split_words(t)] for t in texts]


def cut_up(texts, **how):
    found, at = common.words(pa.array(texts), **how)
    return [found[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 13])
def test_texts_longer_than_a_piece(monkeypatch, size):
    want, sized = one_by_one(SHORT), cut_up(SHORT, sized=True)
    monkeypatch.setattr(common, "PIECE_BYTES", size)
    assert cut_up(SHORT) == want and cut_up(SHORT, sized=True) == sized


def test_texts_over_a_mebibyte(monkeypatch):
    assert max(len(t or "") for t in LONG[:1]) > common.PIECE_BYTES
    got = cut_up(LONG)
    monkeypatch.setattr(common, "PIECE_BYTES", 1 << 30)
    whole = cut_up(LONG)
    assert got == whole and [len(w) for w in got] == [len(split_words(t)) for t in LONG]
    assert [a.tolist() for a in common.per_text(pa.array(LONG))] == whole and np.all(np.diff([len(w) for w in got[:2]]) < 0)
