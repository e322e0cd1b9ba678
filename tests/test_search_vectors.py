"""Ranking against brute force, and the metric layer."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import search, vectors
from ledgerlake.plans import metrics

DOCS = {"1": "apple banana apple", "2": "banana cherry", "3": "apple cherry cherry date", "4": "elder", "5": "apple banana apple"}


@pytest.fixture()
def index(spark):
    rows = [(i, "AB"[int(i) % 2], t) for i, t in DOCS.items()]
    return search.build_index(spark.createDataFrame(rows, "news_id string, ticker string, body string"))


def brute(query):
    docs = {i: t.split() for i, t in DOCS.items()}
    avg = sum(map(len, docs.values())) / len(docs)
    out = {}
    for i, words in docs.items():
        s = 0.0
        for term in set(query.split()):
            df = sum(term in w for w in docs.values())
            tf = words.count(term)
            if tf:
                s += math.log(1 + (len(docs) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / avg))
        if s:
            out[i] = round(s, 6)
    return sorted(out.items(), key=lambda x: (-x[1], x[0]))


@pytest.mark.parametrize("limit", [200_000, 0])
def test_bm25_equals_brute_force_on_both_paths(spark, index, limit):
    q = spark.createDataFrame([("q1", "apple date"), ("q2", "cherry banana cherry")], "query_id string, query string")
    got = search.score(index, q, max_query_terms=limit).collect()
    for qid, text in (("q1", "apple date"), ("q2", "cherry banana cherry")):
        mine = sorted(((r["news_id"], r["score"]) for r in got if r["query_id"] == qid), key=lambda x: (-x[1], x[0]))
        assert [m[0] for m in mine] == [b[0] for b in brute(text)]
        assert np.allclose([m[1] for m in mine], [b[1] for b in brute(text)], atol=2e-6)


def test_search_ticker_restriction_and_ties(spark, index):
    q = spark.createDataFrame([("q", "B", "apple banana")], "query_id string, ticker string, query string")
    got = search.search(index, q, 5, ["ticker"]).orderBy("rank").collect()
    assert [r["news_id"] for r in got] == ["1", "5", "3"] and {r["ticker"] for r in got} == {"B"}


def test_embedding_is_a_unit_vector_and_sees_order_free_tokens(spark):
    df = spark.createDataFrame([("a", "one two two"), ("b", "two ONE two!"), ("c", None), ("d", "...")], "id string, t string")
    e = {r["id"]: np.array(r["embedding"]) for r in vectors.embed(df, "t", 64).collect()}
    assert np.array_equal(e["a"], e["b"]) and abs(np.linalg.norm(e["a"]) - 1) < 1e-6
    assert not e["c"].any() and not e["d"].any() and len(e["c"]) == 64


def test_neighbours_equal_brute_force_with_copies_and_zero_vectors(spark, monkeypatch):
    rng = np.random.default_rng(1)
    base = rng.integers(-2, 3, size=(40, 8)).astype(float)
    base[5] = 0
    # A third of all rows are copies of one vector.
    rows = [(i, base[i].tolist()) for i in range(40)] + [(100 + i, base[0].tolist()) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, vec array<float>").repartition(5)
    targets = spark.createDataFrame([(0,), (7,), (5,), (103,), (39,)], "id long")

    def want(t):
        v = dict(rows)
        a = np.array(v[t])
        out = []
        for i, b in v.items():
            b = np.array(b)
            if i != t and a.any() and b.any():
                out.append((-round(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), 6), i))
        return [i for _, i in sorted(out)[:4]]

    for rows_a_shard, at_once in ((8192, 256), (2, 2)):
        monkeypatch.setattr(vectors, "SHARD_ROWS", rows_a_shard)
        monkeypatch.setattr(vectors, "TARGETS_AT_ONCE", at_once)
        got = vectors.similar(df, targets, 4, "id", "vec").collect()
        for t in (0, 7, 5, 103, 39):
            mine = [r["id"] for r in sorted((r for r in got if r["target_id"] == t), key=lambda r: r["rank"])]
            assert mine == want(t)


def test_candidates_reach_the_exact_neighbours(spark):
    """Recall of the hash tables against exact mode, with crowded buckets dealt into parts."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    rows = [(i, (centres[i % 30] + 0.3 * rng.normal(size=16)).tolist()) for i in range(900)] + [(2000 + i, centres[0].tolist()) for i in range(450)]
    rows += [(3000, [0.0] * 16), (3001, None)]
    df = spark.createDataFrame(rows, "id long, vec array<float>")
    targets = spark.createDataFrame([(i,) for i in [*range(0, 900, 15), 2001, 3000]], "id long")
    exact = {}
    for r in vectors.similar(df, targets, 5, "id", "vec").collect():
        exact.setdefault(r.target_id, []).append((r["rank"], r.id, r.similarity))
    found = []
    for hot in (10_000, 40):
        got = {}
        for r in vectors.similar_candidates(df, targets, 5, "id", "vec", dims=16, tables=16, bits=6, hot=hot).collect():
            got.setdefault(r.target_id, []).append((r["rank"], r.id, r.similarity))
        found.append({t: sorted(v) for t, v in got.items()})
    assert found[0] == found[1] and 3000 not in exact
    hits = sum(len({i for _, i, _ in exact[t]} & {i for _, i, _ in found[0].get(t, [])}) for t in exact)
    assert hits >= 0.9 * sum(len(v) for v in exact.values())
    assert all(s == dict((i, x) for _, i, x in exact[t]).get(i, s) for t, v in found[0].items() for _, i, s in v)
    entries = vectors.hash_tables(df.where("vec is not null"), 16, 6, 16).select("id", F.posexplode("codes").alias("table", "bucket"))
    asked = entries.where("id = 2001").withColumnRenamed("id", "target_id")
    pairs = [tuple(r) for r in vectors.candidate_pairs(entries, asked, 40).collect()]
    assert len(pairs) == len(set(pairs)) and {(2001, 2000 + i) for i in range(450) if i != 1} <= set(pairs)


def test_lateral_calls_take_one_scan(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(f"t{i}", "x", float(i), "c", False, rng.normal(size=8).tolist()) for i in range(80)] + [("zero", "x", 1.0, "c", False, [0.0] * 8)]
    rows += [("copy", "x", 2.0, "c", True, rows[3][5])]
    schema = "txn_id string, txn_text string, amount double, category string, is_fraud_label boolean, embedding array<float>"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "pool"))
    pool = spark.read.parquet(str(tmp_path / "pool"))
    vectors.register_similar_function(spark, pool)
    ids = spark.createDataFrame([("t1",), ("t3",), ("t9",), ("copy",)], "txn_id string")
    vectors.unit_vectors(pool.join(ids, "txn_id", "left_semi")).select("txn_id", "unit").write.parquet(str(tmp_path / "asked"))
    got = vectors.similar_lateral(spark, spark.read.parquet(str(tmp_path / "asked")))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan" in line and "/pool" in line for line in plan.splitlines()) == 1
    want = {(r.target_id, r.txn_id, r.similarity) for r in vectors.similar(pool, ids, 5).collect()}
    assert {(r.target_id, r.txn_id, r.similarity) for r in got.collect()} == want and len(want) == 20


def test_cosine_column(spark):
    df = spark.createDataFrame([([1.0, 2.0], [2.0, 4.0]), ([1.0, 0.0], [0.0, 3.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    got = [r[0] for r in df.select(vectors.cosine(F.col("a"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(1.0) and got[1] == 0.0 and got[2] is None


def test_sample_is_repeatable(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("txn_id"))
    ids = [r[0] for r in vectors.hash_sample(df, 20).collect()]
    assert len(set(ids)) == 20 and ids == [r[0] for r in vectors.hash_sample(df.repartition(7), 20).collect()]


def market(spark):
    rows = [("A", dt.date(2024, 1, 30), 1.0, 0.1, 5), ("A", dt.date(2024, 2, 1), 3.0, 0.3, 6), ("B", dt.date(2024, 2, 1), 9.0, -0.5, 7)]
    return spark.createDataFrame(rows, "ticker string, trade_date date, close double, daily_return double, volume long")


def test_metric_query_synonyms_grain_filters_order_limit(spark):
    out = metrics.metric_query(market(spark), "market", ["Closing Price", "volume"], ["symbol"], grain="month",
                               filters=[("date", ">=", dt.date(2024, 1, 1)), ("stock", "in", ["A", "B"])],
                               order_by=[("total_volume", "desc")], limit=2)
    assert out.columns == ["trade_date_month", "ticker", "close_price", "total_volume"]
    assert [(r["ticker"], r["total_volume"]) for r in out.collect()] == [("B", 7), ("A", 6)]
    assert metrics.metric_query(market(spark), "market", ["volume"]).first()["total_volume"] == 18
    assert metrics.worst_return(market(spark)).first()["ticker"] == "B"


def test_metric_query_rejects_unknown_names(spark):
    with pytest.raises(KeyError):
        metrics.metric_query(market(spark), "market", ["profit"])
    with pytest.raises(ValueError):
        metrics.metric_query(market(spark), "market", ["volume"], grain="eon")


def test_questions_read_their_buckets_only(spark, tmp_path):
    from ledgerlake.operators import search

    word = lambda i: "zebra" + "abcdefgh"[i % 8] * (1 + i // 8)
    rows = [(str(i), "A", f"{word(i)} markets") for i in range(50)]
    news = spark.createDataFrame(rows, "news_id string, ticker string, body string")
    index = search.build_index(news)
    assert "news_id" not in "".join(x for x in index.docs._jdf.queryExecution().toString().splitlines() if "Exchange" in x)
    search.write_index(index, str(tmp_path))
    stored = search.read_index(spark, str(tmp_path))
    q = spark.createDataFrame([("q", word(7))], "query_id string, query string")
    found = search.score(stored, q)
    assert [r.news_id for r in found.collect()] == ["7"]
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [bucket" in plan or "bucket#" in plan.split("PartitionFilters", 1)[1][:200]


def _texts(spark):
    rng = np.random.default_rng(4)
    rows = [(f"t{i}", " ".join(f"w{j}" for j in rng.integers(0, 40, 6))) for i in range(300)]
    return spark.createDataFrame([*rows, ("copy", rows[3][1]), ("blank", ""), ("none", None)], "txn_id string, txn_text string").repartition(3)


def test_texts_become_vectors_in_their_shard(spark):
    """Only texts are shuffled for the search, with the result of stored vectors."""
    texts = _texts(spark)
    asked = texts.where("txn_id in ('t1', 't3', 'copy', 'blank', 'none')")
    want = sorted(map(tuple, vectors.similar(vectors.embed(texts, "txn_text"), vectors.embed(asked, "txn_text"), 4).collect()))
    got = vectors.similar(texts, asked, 4, text_col="txn_text")
    assert sorted(map(tuple, got.collect())) == want and len(want) == 12
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan


def test_candidates_fetch_no_vectors_for_pairs(spark):
    """Candidates are found and ranked inside the shards: no join, so no side can be broadcast."""
    texts = _texts(spark)
    stored = vectors.embed(texts, "txn_text").select("txn_id", "embedding")
    asked = stored.where("txn_id in ('t1', 't3', 'copy', 'blank')")
    near = vectors.similar_candidates(stored, asked, 4, tables=40, bits=6)
    assert "Join" not in near._jdf.queryExecution().executedPlan().toString()
    exact = sorted(map(tuple, vectors.similar(stored, asked, 4).collect()))
    assert sorted(map(tuple, near.collect())) == exact and len(exact) == 12
    wanted = texts.where("txn_id in ('t1', 't3', 'copy', 'blank')")
    assert sorted(map(tuple, vectors.similar_candidates(texts, wanted, 4, tables=40, bits=6, text_col="txn_text").collect())) == exact


def test_lateral_query_computes_the_features_once(spark, monkeypatch):
    """The review list, the sample and the targets all read stored features."""
    from ledgerlake.plans import queries

    plans, pool = [], vectors.vector_pool

    def seen(scored, features):
        plans.extend(df._jdf.queryExecution().executedPlan().toString() for df in (scored, features))
        return pool(scored, features)

    monkeypatch.setattr(vectors, "vector_pool", seen)
    queries.REGISTRY["similar_lateral"](spark, "/root/testdata/sf0.001")
    assert len(plans) == 2 and all("Join" not in p and "Window" not in p for p in plans)
