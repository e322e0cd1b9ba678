import os

import numpy as np

from ledgerlake.llm import jaccard
from tests.llm.conftest import prose, split_words


def sets(text):
    w = split_words(text)
    k = min(5, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()


def brute(rows):
    """component of each id by all pairs; rows of one id are one document."""
    texts = [(i, sets(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, x in texts:
        for b, y in texts:
            if a < b and x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in root}


def check(df):
    got = jaccard.jaccard_components(df).collect()
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = brute(rows)
    assert sorted((r.id is None, r.id or 0, r.n_shingles) for r in got) == sorted((i is None, i or 0, len(sets(t))) for i, t in rows)
    assert {r.id: r.component_id for r in got if r.id is not None} == want
    assert all(r.component_id is None for r in got if r.id is None)


def mutated(text, seed, changes):
    w = text.split()
    rng = np.random.default_rng(seed)
    for i in rng.choice(len(w), changes, replace=False):
        w[i] = f"m{seed}x{i}"
    return " ".join(w)


def test_hard_rows(hard):
    check(hard)


def test_families_around_the_threshold(frame, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)  # several blocks a family
    monkeypatch.setattr(jaccard, "FINE_FROM", 100)
    rows, n = [], 0
    for family in range(4):
        base = prose(100 + family, 60 + 60 * family)
        for k in range(25):
            rows.append((n * 7 % 1009, mutated(base, n, k % 4)))
            n += 1
    rows += [(2000 + i, prose(i, 30) + " " + prose(1, 25)) for i in range(40)]  # a shared passage
    check(frame(rows))


def test_no_rows(frame):
    assert jaccard.jaccard_components(frame([(1, "a")]).where("false")).count() == 0


def test_the_bound_never_cuts_a_link():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 62, 300, dtype=np.uint64)
    members = []
    for k in range(60):
        s = base.copy()
        s[: k % 50] = rng.integers(0, 1 << 62, k % 50, dtype=np.uint64)
        members.append(np.unique(s))
    sizes = np.array([len(m) for m in members])
    points = jaccard.unpack([jaccard.pack(jaccard.grouped(m, jaccard.GROUPS)) for m in members])
    roots = np.arange(60)
    found = set()
    for q, p, _ in jaccard.Tree(roots, sizes, points).search(roots, sizes, points, 80):
        found |= set(zip(q.tolist(), p.tolist()))
    for i, x in enumerate(members):
        for j, y in enumerate(members):
            both = len(np.intersect1d(x, y))
            if i != j and 180 * both >= 80 * (len(x) + len(y)):
                assert (i, j) in found


def test_sql_twin(spark):
    import duckdb

    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert sorted(map(tuple, jaccard.op8_ngram_jaccard_join(spark, sf).collect())) == sorted(c.execute(jaccard.ORACLE).fetchall())
