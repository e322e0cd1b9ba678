import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgerlake.llm import lm
from tests.llm.conftest import prose, split_words


def tokens(text):
    return [*split_words(text), None]


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def test_counts_base_and_interpolation(hard, frame, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 2_000)
    monkeypatch.setattr(lm, "PART_ENTRIES", 500)
    docs = hard.unionByName(frame([(100 + i, prose(i, 60)) for i in range(120)]))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    seen = {}

    def keep(cells, n):
        seen["weights"] = weights(cells, n)
        return seen["weights"]

    weights = lm.mixture
    monkeypatch.setattr(lm, "mixture", keep)
    got = lm.score_texts(docs, held).collect()
    train = [tokens(t) for i, t in rows if not is_held(i)]
    single = Counter(x for t in train for x in t)
    n, v = sum(single.values()), len(single)
    common = {w for w, c in single.items() if c >= max(1, math.ceil(n / 2**20))}
    start = object()
    pair = Counter(p for t in train for p in zip([start, *t[:-1]], t))
    single_before = lambda w: len(train) if w is start else single[w]
    w = seen["weights"]
    want = []
    for i, t in rows:
        ts = tokens(t)
        base = sum(math.log10((single[x] + 1) / (n + v + 1)) for x in ts)
        score = 0.0
        for before, x in zip([start, *ts[:-1]], ts):
            c = single_before(before)
            a = w[lm.Model.bucket(np.array([c]))[0]]
            two = pair[before, x] if x in common and (before is start or before in common) else 0
            score += math.log10(a[0] * two / max(c, 1) + a[1] * single[x] / n + a[2] / (v + 1))
        want.append((i, is_held(i), len(ts), sum(single[x] > 0 for x in ts), n, base, score))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert len(got) == len(want)
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-9)
    assert np.allclose(w.sum(axis=1), 1) and (w >= 0).all()


def test_held_out_texts_gain(frame):
    follow = {w: prose(i, 3).split()[:3] for i, w in enumerate(prose(1, 80).split())}
    words = sorted({x for v in follow.values() for x in v} | set(follow))

    def walk(seed):
        r = np.random.default_rng(seed)
        out = [r.choice(words)]
        while len(out) < 80:
            out.append(str(r.choice(follow.get(out[-1], words))))
        return " ".join(map(str, out))

    docs = frame([(i, walk(i)) for i in range(200)])
    got = lm.score_texts(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2).where("held_out").collect()
    assert sum(r.score for r in got) > 0.95 * sum(r.base_score for r in got) and got


def test_no_rows_and_no_training(hard):
    assert lm.score_texts(hard.where("false"), F.lit(False)).count() == 0
    got = lm.score_texts(hard, F.lit(True)).collect()
    assert len(got) == hard.count() and all(r.train_tokens == 0 and r.score == 0 and r.base_score == 0 for r in got)


def test_mixture_finds_the_better_part():
    cells = np.array([(3 << 40) + ((200_000 + 40) << 20) + 200_000 - 40, (3 << 40) + ((200_000 + lm.NOTHING) << 20) + 200_000 + lm.NOTHING])
    w = lm.mixture(cells, np.array([900.0, 100.0]))
    assert w[3, 0] > 0.85 and w[3, 1] < 0.01 and abs(w[3].sum() - 1) < 1e-9


def test_pairs_of_rare_words_count(frame, monkeypatch):
    monkeypatch.setattr(lm, "SHARE_BITS", 4, raising=False)  # a share of words, were there one, would bite
    monkeypatch.setattr(lm, "CHUNK_BYTES", 1_000)
    monkeypatch.setattr(lm, "PART_ENTRIES", 100)
    rows = [(i, f"{prose(i, 40)} rare{i % 9} pair{i % 9} {prose(i + 50, 5)}") for i in range(60)]
    seen, counts = {}, lm.mixture
    monkeypatch.setattr(lm, "mixture", lambda cells, n: seen.setdefault("weights", counts(cells, n)))
    got = {r.id: r.score for r in lm.score_texts(frame(rows), F.crc32(F.col("doc_id").cast("string")) % 7 == 2).collect()}
    train = [tokens(t) for i, t in rows if not is_held(i)]
    single = Counter(x for t in train for x in t)
    pair = Counter(p for t in train for p in zip(["", *t[:-1]], t))
    single[""], n, v, w = len(train), sum(single.values()), len(single), seen["weights"]
    for i, t in rows:
        want = 0.0
        for a, b in zip(["", *tokens(t)[:-1]], tokens(t)):
            k = w[lm.Model.bucket(np.array([single[a]]))[0]]
            want += math.log10(k[0] * pair[a, b] / max(single[a], 1) + k[1] * single[b] / n + k[2] / (v + 1))
        assert math.isclose(got[i], want, rel_tol=1e-9)
