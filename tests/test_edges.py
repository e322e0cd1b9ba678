"""Hand-made rows for the null, zero, tie and duplicate rules."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from ledgerlake.functions import scalars as S
from ledgerlake.operators import fraud, gold, series, silver, text, views
from ledgerlake.sources import bronze


def payload(symbol, close, epoch=(1704067200, 1704067260, 1704067320)):
    n = len(close)
    c = ",".join("null" if x is None else str(x) for x in close)
    zeros = ",".join(["1"] * n)
    return (
        f'{{"chart":{{"result":[{{"meta":{{"symbol":"{symbol}"}},"timestamp":[{",".join(map(str, epoch[:n]))}],'
        f'"indicators":{{"quote":[{{"open":[{c}],"high":[{c}],"low":[{c}],"close":[{c}],"volume":[{zeros}]}}]}}}}]}}}}'
    )


def landed(spark, rows):
    df = spark.createDataFrame(rows, "ticker string, payload_text string, ingested_at string")
    return bronze.land_market(df.withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz")))


def test_json_null_close_is_dropped(spark):
    out = silver.silver_market(landed(spark, [("A", payload("A", [1.0, None, 3.0]), "2024-01-02")]))
    assert sorted(r["close"] for r in out.collect()) == [1.0, 3.0]


def test_newest_candle_wins_but_not_with_a_null(spark):
    rows = [("A", payload("A", [1.0, 2.0]), "2024-01-02"), ("A", payload("A", [5.0, None]), "2024-01-03")]
    out = silver.silver_market(landed(spark, rows)).orderBy("ts")
    assert [r["close"] for r in out.collect()] == [5.0, 2.0]


def test_source_filter(spark):
    rows = [("A", payload("A", [1.0]), "2024-01-02")]
    both = landed(spark, rows).unionByName(landed(spark, [("A", payload("A", [2.0], (9,)), "2024-01-02")]).withColumn("source", F.lit("backfill")))
    assert silver.silver_market(both).count() == 2
    assert [r["close"] for r in silver.silver_market(both, "backfill").collect()] == [2.0]


def test_empty_and_broken_payloads_are_skipped(spark):
    rows = [("A", "", "2024-01-02"), ("A", None, "2024-01-02"), ("A", "{oops", "2024-01-02"), ("A", "{}", "2024-01-02")]
    raw = landed(spark, rows)
    assert raw.count() == 1
    assert silver.silver_market(raw).count() == 0


def test_pack_then_flatten_returns_the_bars(spark):
    rows = [("A", dt.datetime(2024, 1, d, 0, 0, s), 1.0 * s, 2.0, 0.5, 1.5 + d, s) for d in (1, 2) for s in (3, 1, 2)]
    bars = spark.createDataFrame(rows, "ticker string, ts timestamp_ntz, open double, high double, low double, close double, volume long")
    packed = bronze.pack_chart(bars).withColumn("ingested_at", F.lit("2024-02-01").cast("timestamp_ntz"))
    assert packed.count() == 2
    back = silver.silver_market(bronze.land_market(packed)).drop("ingested_at")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, bars.collect()))


def prices(spark, rows):
    return spark.createDataFrame(rows, "ticker string, trade_date date, close double")


def test_daily_return_first_day_and_zero_previous(spark):
    d = [dt.date(2024, 1, i) for i in (1, 3, 4)]
    out = gold.daily_return(prices(spark, [("A", d[0], 0.0), ("A", d[1], 5.0), ("A", d[2], 6.0)])).orderBy("trade_date")
    assert [r["daily_return"] for r in out.collect()] == [None, None, 6.0 / 5.0 - 1]


def txn(spark, rows):
    """(id, account, hour, amount, category, merchant, country, channel, label) on Sunday 2024-01-07."""
    full = [(i, a, dt.datetime(2024, 1, 7, h), x, c, m, "City 1", co, ch, y) for i, a, h, x, c, m, co, ch, y in rows]
    return spark.createDataFrame(
        full,
        "txn_id string, account_id string, txn_ts timestamp_ntz, amount double, category string, merchant string, "
        "city string, country string, channel string, is_fraud_label boolean",
    )


def test_features_and_rules_with_nulls_and_zeros(spark):
    rows = [
        ("1", "A", 9, 0.0, "x", "M", "US", "online", False),
        ("2", "A", 9, 0.0, "x", None, "NG", "online", False),
        ("3", "B", 4, 2000.0, "y", "M", "US", "in_store", None),
        ("4", None, 9, 10.0, None, "M", "US", "in_store", True),
        ("5", None, 9, 30.0, None, "M", "US", "in_store", False),
        ("6", "B", 9, None, "y", "M", "US", "in_store", False),
    ]
    out = {r["txn_id"]: r for r in fraud.rule_score(gold.txn_features(txn(spark, rows))).collect()}
    assert len(out) == 6
    assert out["1"]["amt_vs_cat_avg"] is None and out["1"]["acct_avg_amount"] == 0.0
    assert out["1"]["txn_dow"] == 0 and out["1"]["rule_score"] == 0
    assert out["2"]["txn_text"] is None and out["2"]["rule_score"] == 1
    assert out["3"]["rule_score"] == 2
    assert out["4"]["acct_avg_amount"] == 20.0 and out["4"]["amt_vs_cat_avg"] == 0.5
    assert out["6"]["acct_avg_amount"] == 2000.0 and out["6"]["amt_vs_cat_avg"] is None


def test_tie_at_the_limit_keeps_the_smaller_id(spark):
    rows = [(str(i), "A", 3, 5.0, "x", "M", "US", "in_store", False) for i in (3, 1, 2)]
    top = fraud.top_candidates(fraud.rule_score(gold.txn_features(txn(spark, rows))), 2)
    assert [r["txn_id"] for r in top.collect()] == ["1", "2"]


def test_label_rule_can_be_left_out(spark):
    f = gold.txn_features(txn(spark, [("1", "A", 9, 5.0, "x", "M", "US", "in_store", True)]))
    assert fraud.rule_score(f, include_label=False).first()["rule_score"] == 0
    assert fraud.rule_score(f).first()["rule_score"] == 1


def test_class_share_of_nothing_is_zero(spark):
    empty = spark.createDataFrame([], "ai_fraud_class string")
    assert fraud.fraud_class_share(empty).first()["suspicious_pct"] == 0.0


def spend(spark, rows):
    return spark.createDataFrame(rows, "spend_date date, txn_count long, total_spend double, avg_ticket double")


def test_kpis_window_edges_and_div0(spark):
    as_of = dt.date(2024, 3, 1)
    day = lambda n: as_of - dt.timedelta(days=n)
    rows = [(day(30), 1, 10.0, 10.0), (day(0), 1, 30.0, 30.0), (day(-1), 1, 5.0, 5.0), (day(31), 1, 20.0, 20.0), (day(60), 1, 5.0, 5.0), (day(61), 9, 99.0, 1.0)]
    k = views.spend_kpis(spend(spark, rows), as_of).first()
    assert (k["spend_30d"], k["txns_30d"], k["avg_ticket_30d"], k["spend_mom_pct"]) == (45.0, 3, 15.0, 80.0)
    zero = views.spend_kpis(spend(spark, [(day(1), 1, 5.0, 5.0), (day(40), 0, 0.0, 0.0)]), as_of).first()
    assert zero["spend_mom_pct"] == 0.0
    none = views.spend_kpis(spend(spark, [(day(1), 1, 5.0, 5.0)]), as_of).first()
    assert none["spend_mom_pct"] is None


def test_sentiment_bounds_are_strict(spark):
    df = spark.createDataFrame([(0.2,), (-0.2,), (0.21,), (-0.21,)], "s double")
    got = [r[0] for r in df.select(text.sentiment_label(F.col("s"))).collect()]
    assert got == ["Neutral", "Neutral", "Positive", "Negative"]


def test_enrichment_of_finance_text(spark):
    n = spark.createDataFrame(
        [("1", "A", "A beats earnings, raises guidance", "Strong quarterly results. The results beat the market."),
         ("2", "A", "Regulators open probe into A", "The stock fell and warned of pressure."),
         ("3", "A", "Nothing", "Plain words only."),
         ("4", "A", None, "No headline.")],
        "news_id string, ticker string, headline string, body string",
    ).withColumn("published_at", F.lit("2024-01-01").cast("timestamp_ntz")).withColumn("source", F.lit("s"))
    out = {r["news_id"]: r for r in text.enrich_news(n).collect()}
    assert out["1"]["sentiment_label"] == "Positive" and out["1"]["topic"] == "Earnings"
    assert out["2"]["sentiment_label"] == "Negative" and out["2"]["topic"] == "Regulation"
    assert out["3"]["sentiment_score"] == 0.0 and out["3"]["topic"] == "Macroeconomy"
    assert out["4"]["sentiment_score"] is None and out["4"]["sentiment_label"] == "Neutral"
    assert out["1"]["summary"] == "The results beat the market."


def points(spark, rows):
    return spark.createDataFrame(rows, "series string, ts timestamp_ntz, y double")


def test_constant_series_has_a_flat_band(spark):
    s = points(spark, [("c", dt.datetime(2024, 1, 1) + dt.timedelta(days=i), 7.0) for i in range(21)])
    rows = series.forecast(s, 7).collect()
    assert len(rows) == 7
    assert all(r["lower_bound"] == r["forecast"] == r["upper_bound"] == 7.0 for r in rows)


def test_short_series_and_band_order(spark):
    day = lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(days=i)
    s = points(spark, [("one", day(0), 3.0), ("two", day(0), 3.0), ("two", day(1), 5.0)]
               + [("many", day(i), float((i * 37) % 11)) for i in range(60)])
    rows = series.forecast(s, 3).collect()
    assert len(rows) == 9
    assert all(r["lower_bound"] <= r["forecast"] <= r["upper_bound"] for r in rows)
    assert {r["forecast"] for r in rows if r["series"] == "one"} == {3.0}


def test_spike_is_an_anomaly(spark):
    day = lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(days=i)
    s = points(spark, [("s", day(i), 100.0 + (i % 3)) for i in range(90)] + [("s", day(90), 500.0), ("s", day(91), 101.0)])
    train, ev = series.split_series(s, dt.date(2024, 4, 30), 30)
    found = series.detect_anomalies(train, ev)
    assert [r["y"] for r in found.where("is_anomaly").collect()] == [500.0]
    counts = series.anomaly_counts(s=found).first()
    assert (counts["anomalies"], counts["points"]) == (1, ev.count())


def test_scalars(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (6.0, 3.0)], "a double, b double")
    got = df.select(S.div0(F.col("a"), F.col("b")), S.ratio(F.col("a"), F.col("b")), S.flag(F.col("b") > 1)).collect()
    assert [tuple(r) for r in got] == [(0.0, None, 0), (None, None, 0), (2.0, 2.0, 1)]
    big = df.limit(1).select(S.money(F.lit(12345678.9)).alias("m")).first()["m"]
    assert big == "12345678.90"


def test_breadth_counts_unknown_as_up(spark):
    df = spark.createDataFrame([("A", None), ("B", -1.0), ("C", 0.0)], "ticker string, day_change_pct double")
    assert tuple(views.breadth(df).first()) == (2, 3)


def test_densify(spark):
    dim = spark.createDataFrame([("A",), ("B",)], "ticker string")
    span = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 3))], "d0 date, d1 date")
    assert views.densify(dim, bronze.date_spine(span)).count() == 6


def _best_by_hand(body, n):
    import re

    sents = re.findall(r"[^.!?\n]+[.!?]?", body or "")
    words = [re.findall(r"[a-z]+", x.lower()) for x in sents]
    tf = {}
    for w in words:
        for t in w:
            tf[t] = tf.get(t, 0) + 1
    scored = [(-round(sum(tf[t] for t in w) / len(w), 6), i) for i, w in enumerate(words) if w]
    keep = sorted(i for _, i in sorted(scored)[:n])
    return " ".join(sents[i].strip(" ") for i in keep) if keep else None


def test_summary_equals_brute_force_in_any_batching(spark):
    import random

    rng = random.Random(3)
    bodies = [None, "", "...", "One."] + [
        " ".join(rng.choice("ab cd ef gh. ij! kl? mn\n op".split(" ")) for _ in range(rng.randint(1, 60))) for _ in range(60)
    ]
    df = spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "news_id string, body string").coalesce(1)
    for size in ("10000", "3"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        for n in (1, 2, 5):
            got = {r["news_id"]: r["summary"] for r in text.summarize(df, n).collect()}
            assert got == {str(i): _best_by_hand(b, n) for i, b in enumerate(bodies)}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    nothing = df.where("body is null or body = ''")
    assert {r["summary"] for r in text.summarize(nothing).collect()} == {None}


def test_means_do_not_depend_on_the_partitioning(spark):
    from ledgerlake.operators import gold

    rows = [(str(i), "A", f"c{i % 3}", round(i * 7.77 % 1000, 2)) for i in range(3000)]
    df = spark.createDataFrame(rows, "txn_id string, account_id string, category string, amount double")
    got = [sorted(map(tuple, gold.account_means(df.repartition(n)).collect())) for n in (1, 3, 7)]
    assert got[0] == got[1] == got[2]


def test_reasons_follow_the_rules_that_fired(spark):
    from ledgerlake.operators import fraud

    row = [("1", 2000.0, "travel", "online", "NG", 9.0, 12, True)]
    df = spark.createDataFrame(row, "txn_id string, amount double, category string, channel string, country string, amt_vs_cat_avg double, txn_hour int, is_fraud_label boolean")
    how = {"ratio_gt": 10, "amount_gt": 5000, "include_label": False}
    scored = fraud.rule_score(df, **how).withColumn("ai_fraud_class", F.lit("Suspicious"))
    got = fraud.explain_fraud(scored, **how).first()
    assert got.rule_score == 1 and "usual" not in got.ai_reason and "labelled" not in got.ai_reason and "online from NG" in got.ai_reason


def test_sinks_refuse_unknown_columns(spark):
    from ledgerlake.sources import tables

    spark.sql("DROP TABLE IF EXISTS narrow_sink")
    spark.range(2).write.saveAsTable("narrow_sink")
    with pytest.raises(ValueError, match="extra"):
        tables.append_by_name(spark.range(2).withColumn("extra", F.lit(1)), "narrow_sink")


def test_repeated_stamps(spark):
    """Of equal stamps: smallest open and largest close of a bar; for the latest price the largest close, then volume."""
    rows = [("a", "2024-01-01 10:00:00", 5.0, 6.0, 4.0, 5.5, 10), ("a", "2024-01-01 10:00:00", 4.5, 7.0, 4.0, 5.0, 20), ("a", "2024-01-01 11:00:00", 9.0, 9.0, 8.0, 8.5, 1),
            ("a", "2024-01-01 11:00:00", 8.0, 9.0, 8.0, 8.5, 3), ("a", "2024-01-01 11:00:00", 8.0, 9.5, 7.0, 8.0, 9), ("b", None, 1.0, 1.0, 1.0, 1.0, 1)]
    df = spark.createDataFrame(rows, "ticker string, ts string, open double, high double, low double, close double, volume long").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = {r.ticker: tuple(r)[2:] for r in gold.ohlc_daily(df).collect()}
    assert got["a"] == (4.5, 9.5, 4.0, 8.5, 43)
    last = {r.ticker: r for r in views.latest_per_key(df).collect()}
    assert (last["a"].close, last["a"].volume) == (8.5, 3) and last["b"].close is None
    once = gold.per_stamp(df)
    assert sorted(gold.ohlc_daily(once, keyed=True).collect(), key=str) == sorted(gold.ohlc_daily(df).collect(), key=str)


def test_word_lists_of_any_length(spark, monkeypatch):
    """Fifty thousand words by a join; the same rows as the literal lists give, on both join paths."""
    words = [f"w{a}{b}{c}{d}" for a in "abcdefghijklmno" for b in "abcdefghijklmno" for c in "abcdefghijklmno" for d in "abcdefghijklmno"][:50_000]
    lists = {"positive": words[:20_000], "negative": words[19_990:40_000], "keywords": {"Earnings": dict.fromkeys(words[39_000:45_000], 2), "Product": dict.fromkeys(words[44_000:], 3)}}
    rows = [(str(i), dt.datetime(2024, 1, 1), "A", words[i * 97 % 50_000], " ".join(words[(i * 31 + j * 977) % 50_000] for j in range(i % 9)) + " other", "s") for i in range(60)]
    rows += [("n", None, "A", None, words[0], "s"), ("m", None, "A", "h", None, "s"), ("e", None, "A", "", "", "s"), rows[3]]
    news = spark.createDataFrame(rows, "news_id string, published_at timestamp_ntz, ticker string, headline string, body string, source string")
    got = sorted(map(str, text.news_sentiment(news, **lists).collect()))
    few = {"positive": words[:200], "negative": words[150:300], "keywords": {"Analyst Rating": {words[5]: 1, words[200]: 4}, "M&A": {words[5]: 1}}}
    small = sorted(map(str, text.news_sentiment(news, **few).collect()))
    monkeypatch.setattr(text, "MAX_WORDS", 60_000)
    assert got == sorted(map(str, text.news_sentiment(news, **lists).collect()))
    monkeypatch.setattr(text, "MAX_WORDS", 10)
    assert small == sorted(map(str, text.news_sentiment(news, **few).collect()))
    join = text.lookup_join
    monkeypatch.setattr(text, "lookup_join", lambda *a, **k: join(*a, **{**k, "max_broadcast_rows": 0}))
    assert small == sorted(map(str, text.news_sentiment(news, **few).collect()))
