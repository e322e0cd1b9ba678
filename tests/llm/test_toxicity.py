import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerlake.llm import toxicity as tox
from tests.llm.conftest import prose


def _docs(frame, n=400):
    rows = [(i, prose(i, 60) + (" you pathetic idiot you worthless clown" if i % 5 == 0 else "")) for i in range(n)]
    return frame(rows)


def test_learns_and_holds_out(spark, frame):
    docs = _docs(frame)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)], "doc_id long, toxic int")
    model = tox.fit(docs, labels)
    got = model.score(docs).select("doc_id", "score", "predicted", tox.side(F.col("doc_id")).alias("side")).collect()
    held = [r for r in got if r.side == 2]
    assert held and all(0 <= r.score <= 1 and r.predicted == int(r.score >= tox.THRESHOLD) for r in got)
    assert all(r.predicted == int(r.doc_id % 5 == 0) for r in held)
    # Labels of held-out rows must not matter.
    flipped = labels.withColumn("toxic", F.when(tox.side(F.col("doc_id")) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in tox.fit(docs, flipped).score(docs).collect()}
    assert again == {r.doc_id: r.score for r in got}


def test_hard_rows_and_one_sided_labels(spark, hard):
    labels = spark.createDataFrame([(3, 0), (4, None), (None, 1)], "doc_id long, toxic int")
    got = tox.fit(hard, labels).score(hard)
    assert got.count() == hard.count()
    assert got.where("score is null or score != 0 or predicted != 0").count() == 0
    none = tox.fit(hard, labels.where("false")).score(hard.where("false"))
    assert none.count() == 0


def test_features_do_not_depend_on_the_batch():
    texts = ["You are an IDIOT!!", "", "st*pid 1d10t", "i d i o t soooo", prose(1, 400), "é" * 50, "clean words only"]
    lists = {"insults": tox.hashes_of(tox.INSULTS), "threats": tox.hashes_of(tox.THREATS), "second": tox.hashes_of(tox.SECOND)}
    lists["leet"] = tox.hashes_of(tox.INSULTS, fold=tox.LEET, gaps=tox.NOT_LEET)
    whole = tox._features(pa.array(texts), lists)
    assert np.allclose(whole, np.concatenate([tox._features(pa.array([t]), lists) for t in texts]))
    at = dict(zip(tox.NAMES, whole.T))
    assert at["near"][0] > 0 and at["insults"][0] == 1 / 4 and at["hidden"][2] > 0 and at["masked"][2] > 0
    assert at["spaced"][3] > 0 and at["drawn"][3] > 0 and not whole[6, : tox.NAMES.index("foreign")][[0, 3, 5, 8]].any()


def plain_features(text, lexicon=None):
    """Every feature of one text, computed letter by letter."""
    raw = text.encode()
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in raw)
    is_letter = lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128

    def cut(data, ok):
        out, now = [], b""
        for b in data:
            if ok(b):
                now += bytes([b])
            else:
                out, now = out + [now] * bool(now), b""
        return out + [now] * bool(now)

    listed = {k: {w.encode() for w in v} for k, v in (("i", tox.INSULTS), ("t", tox.THREATS), ("s", tox.SECOND))}
    swap = dict(zip(b"013457@$!", b"oieastasi"))
    found = cut(low, is_letter)
    leet = [bytes(swap.get(b, b) for b in w) for w in cut(low, lambda b: is_letter(b) or b in swap)]
    known = {bytes(swap.get(b, b) for b in w.encode()) for w in tox.INSULTS}
    n, letters, size = max(len(found), 1), sum(map(is_letter, raw)), max(len(raw), 1)
    insult = [w in listed["i"] for w in found]
    second = [w in listed["s"] for w in found]
    hidden = max(sum(w in known for w in leet) - sum(insult), 0)
    near = sum(any(second[max(i - tox.NEAR, 0) : i + tox.NEAR + 1]) for i, x in enumerate(insult) if x)
    spots = [sum(insult[i : i + tox.WINDOW]) for i, x in enumerate(insult) if x]
    upper = [65 <= b <= 90 for b in raw]
    at = range(1, len(raw) - 1)
    starts = [w.decode(errors="replace")[: tox.START].encode() for w in found]
    weight = [max((lexicon or {}).get(("w", w), 0), (lexicon or {}).get(("s", s), 0)) for w, s in zip(found, starts)]
    told = [sum(weight[i : i + tox.WINDOW]) for i, x in enumerate(weight) if x]
    return [
        sum(insult) / n, np.log1p(sum(insult)), max(spots, default=0), sum(w in listed["t"] for w in found) / n, sum(second) / n, near / n,
        sum(upper) / max(letters, 1), sum(upper[i] and upper[i - 1] and upper[i - 2] for i in range(2, len(raw))) / max(letters, 1),
        *(sum(b in m for b in raw) / size for m in tox.MARKS.values()),
        hidden / n, np.log1p(hidden), sum(raw[i] == 42 and is_letter(raw[i - 1]) and is_letter(raw[i + 1]) for i in at) / n,
        sum(is_letter(raw[i]) and raw[i] < 128 and not is_letter(raw[i - 1]) and not is_letter(raw[i + 1]) for i in at) / n,
        sum(is_letter(raw[i]) and raw[i] == raw[i - 1] == raw[i - 2] for i in range(2, len(raw))) / max(letters, 1),
        sum(b >= 128 for b in raw) / size, max(letters, 1) / n, np.log1p(len(found)),
        sum(weight) / n, np.log1p(sum(weight)), max(told, default=0), np.log1p(len({s for s, w in zip(starts, weight) if w})),
    ]


def test_features_by_brute_force():
    texts = ["You are an IDIOT!!! you stup1d tr@sh, kill it", "", " ", "s*t *a i d i o t sooooo AAAA", "éé ÜBER blöd réeuxxx réeux", prose(1, 300), "x" * 3000, "dich hassen 12 $$ you idiot"]
    taught = {("w", b"xxx"): 2.0, ("w", "réeux".encode()): 1.5, ("s", "réeu".encode()): 1.25, ("s", b"abc"): 0.5, ("s", b"the"): 0.75}
    hashed = []
    for (kind, word), w in taught.items():
        at = tox.terms(pa.array([word.decode()]))
        hashed.append((at[0 if kind == "w" else 1][0], w))
    hashed.sort()
    lexicon = tox.Lexicon(np.array([h for h, _ in hashed], np.uint64), np.array([w for _, w in hashed]))
    lists = {"insults": tox.hashes_of(tox.INSULTS), "threats": tox.hashes_of(tox.THREATS), "second": tox.hashes_of(tox.SECOND)}
    lists["leet"] = tox.hashes_of(tox.INSULTS, fold=tox.LEET, gaps=tox.NOT_LEET)
    got = tox._features(pa.array(texts), lists, lexicon)
    for text, row in zip(texts, got):
        for name, x, y in zip(tox.NAMES, row, plain_features(text, taught)):
            assert abs(x - y) < 1e-9, (text[:40], name, x, y)


def test_taught_lexicon_finds_unlisted_words(spark, frame):
    """Four languages' worth of words that no list holds; held-out rows are caught, others left alone."""
    slurs = ["achlung", "bomeris", "réeumant", "zqwarble"]
    rows = [(i, prose(i, 50) + (f" {slurs[i % 4]}{'xyz'[i % 3]}" * 3 if i % 6 == 0 else "")) for i in range(1200)]
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(1200)], "doc_id long, toxic int")
    docs = frame(rows)
    got = tox.fit(docs, labels).score(docs).select("doc_id", "predicted", tox.side(F.col("doc_id")).alias("side")).collect()
    held = [r for r in got if r.side == 2]
    for kind in range(4):
        caught = [r.predicted for r in held if r.doc_id % 6 == 0 and r.doc_id % 4 == kind]
        assert not caught or np.mean(caught) >= 0.9
    assert np.mean([r.predicted for r in held if r.doc_id % 6]) <= 0.02
