import random
import re

import pytest

PHRASES = "the of and to in is that it for was on be with as by at or an this are".split()
FRAME = "doc_id long, text string, lang string, source string, n_chars long, score double, id long, words string, k_id string"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 7))) if r.random() < 0.6 else r.choice(PHRASES) for _ in range(n))


def split_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


@pytest.fixture
def frame(spark):
    """Documents with further columns whose names clash with those the operators use inside."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0.5, 9, "x", "y") for i, t in rows], FRAME)

    return make


@pytest.fixture
def hard(frame):
    """Nulls, empty and very long texts, repeated rows, ties."""
    long = prose(5, 30_000)
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, long), (4, long), (5, "one two"), (6, "One TWO"), (7, prose(7, 80)), (7, prose(7, 80))]
    rows += [(None, prose(8, 40)), (8, prose(8, 40)), (9, "x" * 200_000), (-1, "Ünïcode  \x0b words é")]
    return frame(rows)
