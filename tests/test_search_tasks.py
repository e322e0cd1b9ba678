"""What one task of a whole search holds."""

from ledgerlake.operators import search


def test_parts_follow_articles_times_queries(spark, monkeypatch):
    docs = [(f"n{i}", "T", f"alpha w{i % 7} beta w{i % 3}") for i in range(300)]
    news = spark.createDataFrame(docs, "news_id string, ticker string, body string")
    queries = spark.createDataFrame([(f"q{i}", f"alpha w{i}") for i in range(10)], "query_id string, query string")

    def ranked():
        return sorted(map(tuple, search.search(search.build_index(news), queries, 3, ["ticker"]).collect()))

    want = ranked()
    monkeypatch.setattr(search, "PAIRS_PER_TASK", 50)
    scored = search.score(search.build_index(news), queries)
    sizes = scored.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 3000 and len(sizes) == 60 and max(sizes) <= 4 * 50
    assert ranked() == want
