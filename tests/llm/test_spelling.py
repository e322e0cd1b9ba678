import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np

from ledgerlake.llm import spelling
from tests.llm.conftest import prose


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(words, ratio=5):
    """{word: (form, root, n, n_near, form_n)}"""
    listed, out = sorted(words), {}
    form = {}
    for w in listed:
        close = [o for o in listed if near(w, o)]
        best = min(close, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
        out[w] = len(close)
    result = set()
    for w in listed:
        root = w
        while form[root] is not None:
            root = form[root]
        result.add((w, form[w], root, words[w], out[w], words[form[w]] if form[w] else None))
    return result


def text_words(rows, every=199, least=6, count=5):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= count}


def variants(seed, n, letters="abcdé"):
    """Words with many near ones, of chains of counts."""
    r = random.Random(seed)
    words = {}
    for _ in range(n):
        w = "".join(r.choices(letters, k=r.randint(6, 9)))
        for step in range(r.randint(1, 6)):
            words[w] = words.get(w, 0) + r.choice([5, 6, 30, 150, 800, 4000])
            at = r.randrange(len(w))
            w = r.choice([w[:at] + w[at + 1 :], w[:at] + r.choice(letters) + w[at:], w[:at] + r.choice(letters) + w[at + 1 :]])
            w = w if len(w) >= 6 else w + "bb"
    return words


def found(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_forms_match_brute_force(spark):
    words = variants(1, 250)
    words |= {"aaaaaa": 900, "aaaaaaa": 100, "aaaaaaaa": 10, "abcabcabc": 7, "é" * 7: 50, "\U0001f600bcdefg": 10, "xbcdefg": 70}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    want = brute(words)
    assert found(spelling.spelling_variants(df)) == want
    # Buckets of 17 words and more are parted down to the last letter.
    assert found(spelling.spelling_variants(df, cells=1)) == want
    assert max(r["count"] for r in spelling.buckets(df, 1).groupBy(*spelling.KEY).count().collect()) <= 16


def test_every_pair_once(spark):
    words = variants(2, 200, "ab")
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    for cells in (1, 200, 1 << 14):
        got = [(r.word, r.other) for r in spelling.near_words(df, cells).collect()]
        assert len(got) == len(set(got))
        assert set(got) == {(a, b) for a in words for b in words if near(a, b)}


def test_blocks_and_strips(monkeypatch):
    words = sorted(variants(3, 80))
    at = [len(w) for w in words]
    m = 9
    words = [w for w, n in zip(words, at) if n in (8, 9)]
    keys, rest = np.zeros(len(words), int), np.array([[0] * len(words), [0] * len(words), [m] * len(words)])
    want = {(a, b) for a in words for b in words if a < b and near(a, b) and max(len(a), len(b)) == m}
    for block, strip in ((9, 1), (100, 1 << 16), (1 << 12, 4)):
        monkeypatch.setattr(spelling, "BLOCK_CELLS", block)
        monkeypatch.setattr(spelling, "STRIP_CELLS", strip)
        i, j = spelling.near_in(words, np.full(len(words), m), keys, rest)
        assert sorted(zip(i, j)) == sorted(set(zip(i, j)))
        assert {tuple(sorted((words[x], words[y]))) for x, y in zip(i, j)} == want


def rows_of_text():
    r = random.Random(4)
    words = variants(5, 60)
    words, weights = list(words), list(words.values())
    rows = [(i, " ".join(r.choices(words, weights, k=150)).capitalize() + f" {prose(i, 9)}-GROßE{words[0].upper()}") for i in range(80)]
    long = "ab" * 30_000
    rows += [(i, long + ("c" if i > 205 else "")) for i in range(200, 212)]
    return rows + [(90, None), (91, ""), (92, " \t"), (None, " ".join(words)), (93, rows[0][1]), (94, "×abcdef÷")]


def test_whole_texts(spark, frame, hard, tmp_path):
    rows = rows_of_text() + [rows_of_text()[1]]
    want = brute(text_words(rows))
    got = found(spelling.spelling_variants(spelling.counted(spelling.misspelt(frame(rows)))))
    assert got == want and any(r[1] for r in want)
    assert spelling.spelling_variants(spelling.counted(spelling.misspelt(hard.where("false")))).count() == 0
    want = brute(text_words([(r.doc_id, r.text) for r in hard.collect()]))
    assert found(spelling.spelling_variants(spelling.counted(spelling.misspelt(hard)))) == want

    frame([r for r in rows if len(r[1] or "") < 50_000]).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert found(spelling.op12_spelling_variants(spark, str(tmp_path))) == set(duck.execute(spelling.ORACLE).fetchall())
