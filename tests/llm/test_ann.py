import numpy as np

from ledgerlake.llm import ann


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1) for i, v in rows], "vec_id long, embedding array<float>, ids int")


def brute(rows, queries, k):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v) and len(v) == 16:
            ok.setdefault(i, np.array(v, np.float32).astype(float))
    out = {}
    for q in queries:
        if q in ok:
            near = sorted((np.sqrt(((v - ok[q]) ** 2).sum()), i) for i, v in ok.items() if i != q)[:k]
            out[q] = near
    return out


def test_recall_scores_and_hard_rows(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 300)
    rng = np.random.default_rng(0)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(900, 16)))]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # one vector many times
    rows += [(2000, None), (2001, [0.0] * 16), (2002, [None] + [1.0] * 15), (2003, [float("nan")] * 16), (2004, [1.0] * 3), (None, [1.0] * 16)]
    rows.append(rows[5])
    df = ann.usable(frame(spark, rows), "vec_id", "embedding")
    got = {}
    for r in ann.search(df, df.where("id % 50 = 0"), 10).orderBy("query", "rank").collect():
        got.setdefault(r["query"], []).append((r["score"], r["id"]))
    want = brute(rows, range(0, 2100, 50), 10)
    assert set(got) == set(want)
    found = total = 0
    exact = {q: dict((i, d) for d, i in brute(rows, [q], 10_000)[q]) for q in want}
    for q, near in want.items():
        assert len(got[q]) == 10 and got[q] == sorted(got[q])
        assert all(abs(d - exact[q][i]) < 1e-12 for d, i in got[q])
        found += len({i for _, i in near} & {i for _, i in got[q]})
        total += 10
    assert found / total >= 0.9
    assert [i for _, i in got[0]] == list(range(1000, 1010))  # ties to the smaller id


def test_probing_returns_the_whole_hamming_ball():
    rng = np.random.default_rng(1)
    bits = rng.random((500, 40)) > 0.5
    shard = ann.Shard(bits)
    for radius in (0, 3, 9, 14, 40):
        for q in bits[:5]:
            assert shard.within(q, radius, {}).tolist() == np.flatnonzero((bits != q).sum(axis=1) <= radius).tolist()


def test_few_rows(spark):
    df = ann.usable(frame(spark, [(0, [1.0] * 16), (100, [2.0] * 16)]), "vec_id", "embedding")
    assert [tuple(r) for r in ann.search(df, df.where("id = 0")).collect()] == [(0, 1, 100, 4.0)]
    assert ann.search(df.where("false"), df).count() == 0
