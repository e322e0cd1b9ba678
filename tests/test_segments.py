"""The segment index against scoring every article: bounds, re-sends, merges."""

import datetime as dt
import random

import pytest

from ledgerlake.operators import search, segments
from ledgerlake.sources.versioned import Lake

SCHEMA = "news_id string, published_at timestamp_ntz, ticker string, headline string, body string, source string"
WORDS = "market shares rise fall profit loss bank oil gold rate trade tax fund bond yield zebra".split()


def article(i, seed, version=1, long=False):
    r = random.Random(seed)
    words = r.choices(WORDS, [30, 20, 15, 12, 10, 9, 8, 7, 6, 5, 4, 3, 3, 2, 2, 1], k=r.randint(80, 200) if long else r.randint(2, 20))
    return str(i), dt.datetime(2024, 1, version), "AB"[i % 2], f"h{i}", " ".join(words), "s"


def queries(spark, ticker=False):
    asked = [("q1", "zebra market"), ("q2", "bond yield tax"), ("q3", "market shares rise"), ("q4", "gold gold oil"), ("q5", "nothing here"), ("q6", "zebra")]
    if ticker:
        return spark.createDataFrame([(q, "B", t) for q, t in asked], "query_id string, ticker string, query string")
    return spark.createDataFrame(asked, "query_id string, query string")


def rows_of(df):
    return sorted((r.query_id, r["rank"], r.news_id, r.score, r.headline) for r in df.collect())


def check(spark, root, live, k=4):
    index = search.build_index(spark.createDataFrame(list(live.values()), SCHEMA))
    for ticker in (False, True):
        q = queries(spark, ticker)
        assert rows_of(segments.search(spark, root, q, k, ["headline"])) == rows_of(search.search(index, q, k, ["headline"]))


def test_equals_full_scoring_after_resends_and_merges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(segments, "FAN", 3)
    monkeypatch.setattr(segments, "BLOCK_DOCS", 8)
    monkeypatch.setattr(segments, "FIRST_BLOCKS", 2)
    root, live, r = str(tmp_path), {}, random.Random(1)
    for step in range(7):
        ids = [step * 20 + i for i in range(20)] + r.sample(sorted(map(int, live)), min(len(live), 6))
        batch = [article(i, 1000 * step + i, 1 + step, long=i % 4 == 0) for i in ids]
        live |= {a[0]: a for a in batch}
        segments.refresh(spark, spark.createDataFrame(batch + batch[:3], SCHEMA), root, batch_id=step)
        segments.refresh(spark, spark.createDataFrame(batch, SCHEMA), root, batch_id=step)  # a replay
        if step in (1, 6):
            check(spark, root, live)
    lake = Lake(spark, root)
    sizes = segments.segment_sizes(lake)
    assert sum(sizes.values()) == lake.state().numbers["n"] == len(live) == 140
    assert len(sizes) <= 5 and lake.vacuum(1) > 0
    check(spark, root, live)


def test_blocks_are_skipped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(segments, "BLOCK_DOCS", 16)
    root = str(tmp_path)
    live = {a[0]: a for a in (article(i, i, long=i % 3 > 0) for i in range(1200))}
    segments.refresh(spark, spark.createDataFrame(list(live.values()), SCHEMA), root)
    check(spark, root, live)
    found = segments.Search(spark, root, queries(spark), 4)
    total, first, rest = (df.groupBy("query_id").count() for df in (found.bounds, found.first, found.rest))
    total, first, rest = ({r.query_id: r["count"] for r in df.collect()} for df in (total, first, rest))
    skipped = {q: n - first[q] - rest.get(q, 0) for q, n in total.items()}
    assert sum(skipped.values()) > 0.5 * sum(total.values()) and "q5" not in total


def test_empty_and_odd_articles(spark, tmp_path):
    root = str(tmp_path)
    rows = [("1", dt.datetime(2024, 1, 1), None, "h", "zebra market", "s"), ("2", None, "A", "h", None, "s"), ("3", None, "A", "h", "", "s"), (None, None, "A", "h", "zebra", "s")]
    segments.refresh(spark, spark.createDataFrame(rows, SCHEMA).where("false"), root)
    assert segments.search(spark, root, queries(spark)).count() == 0
    segments.refresh(spark, spark.createDataFrame(rows, SCHEMA), root)
    assert {r.news_id for r in segments.search(spark, root, queries(spark)).collect()} == {"1"}


@pytest.mark.parametrize("limit", [200_000, 0])
def test_without_broadcasts(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(segments, "BROADCAST_TERMS", limit)
    live = {a[0]: a for a in (article(i, i) for i in range(60))}
    segments.refresh(spark, spark.createDataFrame(list(live.values()), SCHEMA), str(tmp_path))
    check(spark, str(tmp_path), live)


def test_postings_are_counted_by_block(spark, monkeypatch):
    """One shuffle, of articles by block: words are neither exploded nor grouped by a shuffle."""
    monkeypatch.setattr(segments, "BLOCK_DOCS", 8)
    live = [article(i, i, long=i % 5 == 0) for i in range(90)] + [("none", dt.datetime(2024, 1, 1), "A", "h", None, "s")]
    docs = segments._documents(spark.createDataFrame(live, SCHEMA).repartition(3), "body", "s1")
    got = segments._postings(docs, "body")
    plan = got._jdf.queryExecution().executedPlan().toString()
    dealt = plan[plan.index("MapInArrow"):].split("Join")[0]
    assert "Generate" not in plan and "Aggregate" not in dealt and dealt.count("Exchange") == 1
    block = {r.news_id: r.block for r in docs.collect()}
    want = {}
    for news_id, _, ticker, _, body, _ in live:
        words = (body or "").split()
        for w in set(words):
            want.setdefault((block[news_id], ticker, w), []).append((news_id, words.count(w), len(words)))
    rows = {(r.block, r.ticker, r.term): r for r in got.collect()}
    assert {k: sorted(zip(r.ids, r.tfs, r.dls)) for k, r in rows.items()} == {k: sorted(v) for k, v in want.items()}
    assert all((r.n, r.max_tf, r.min_dl) == (len(r.ids), max(r.tfs), min(r.dls)) for r in rows.values())
