import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import hard_negatives as hn


def frame(spark, rows):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], y, 1, "h") for i, v, y in rows]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, shard int, h string")


def brute(rows, step, low=50, high=95, positives=5, negatives=3):
    own = {}
    for i, v, y in rows:
        if i is None or v is None or y is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        own[(i, tuple(v), y)] = (i, y, [math.floor(256 * x) for x in v])
    own = list(own.values())
    out = []
    for a, label, v in own:
        if a % step:
            continue
        scored = sorted((-max(-hn.LONG, min(hn.LONG, sum(p * q for p, q in zip(v, w)))), i, y) for i, y, w in own if i != a)
        for s, p, _ in [r for r in scored if r[2] == label][:positives]:
            fits = [r for r in scored if r[2] != label and low * -s <= 100 * -r[0] <= high * -s][:negatives]
            out += [(a, p, k, i, -s, -t) for k, (t, i, _) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, step=10, **how):
    df = hn.usable(frame(spark, rows), "vec_id", "embedding", F.col("label"))
    return sorted(map(tuple, hn.mine_hard_negatives(df, df.where(F.col("id") % step == 0), **how).collect()))


def made(seed, n, dim=8, labels=4):
    rng = np.random.default_rng(seed)
    return [(i, v.tolist(), int(y)) for i, v, y in zip(range(n), rng.normal(size=(n, dim)), rng.integers(0, labels, n))]


def test_matches_brute_force(spark, monkeypatch):
    rows = made(0, 500)
    monkeypatch.setattr(hn, "SHARD_ROWS", 40)
    want = brute(rows, 10)
    assert mined(spark, rows) == want and len(want) > 300
    assert mined(spark, rows, positives=2, negatives=7, span=hn.Span(10, 80)) == brute(rows, 10, 10, 80, 2, 7)


def test_ties_zeros_and_one_common_vector(spark):
    rng = np.random.default_rng(3)
    small = [(i, (rng.integers(-1, 2, 3) / 256).tolist(), int(rng.integers(0, 3))) for i in range(300)]
    assert mined(spark, small) == brute(small, 10)
    common = [(i, [0.5, 0.25, 0.0], i % 3) for i in range(400)] + made(4, 60, 3, 3)
    assert mined(spark, common, 50) == brute(common, 50)


def test_hard_rows(spark):
    rows = made(5, 120)
    rows += [rows[3], rows[10], (10, [0.25] * 8, 1), (20, [9.0] * 8, None)]
    rows += [(None, [1.0] * 8, 0), (201, None, 0), (202, [None] + [1.0] * 7, 0), (203, [math.nan] * 8, 1), (204, [math.inf] * 8, 1)]
    rows += [(210, [], 0), (211, [0.0] * 8, 1), (212, [-0.0] * 8, 1), (213, [2.0], 2), (214, [1e30] * 8, 1), (220, [-3e38] * 8, 2)]
    assert mined(spark, rows) == brute(rows, 10)
    assert mined(spark, [(0, [1.0], 0)]) == [] and mined(spark, []) == []


def test_iterator_holds_windows_only():
    # A positive of score 0 comes after negatives of score 0 with smaller ids.
    rows = [(1, 0, 100, 9, True), (1, 0, 95, 2, False), (1, 0, 60, 3, False), (1, 0, 49, 4, False), (1, 0, 0, 5, False), (1, 0, 0, 6, True), (1, 0, 0, 7, False)]
    got = list(hn.emitted(iter(rows), hn.Span(), 3))
    assert got == [(1, 9, 1, 2, 100, 95), (1, 9, 2, 3, 100, 60), (1, 6, 1, 5, 0, 0), (1, 6, 2, 7, 0, 0)]
    with pytest.raises(ValueError):
        hn.Span(50, 100)


def test_query_matches_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    got = sorted(map(tuple, hn.op11_hard_negatives(spark, sf).collect()))
    assert got == sorted(duck.execute(hn.ORACLE).fetchall()) and got
