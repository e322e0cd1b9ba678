"""Landing of JSON files, sinks, jobs and views."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import silver
from ledgerlake.plans import jobs
from ledgerlake.sources import bronze, tables


def rec(i, amount=1.0, ts="2024-01-01T10:00:00"):
    return {"txn_id": str(i), "account_id": "A", "ts": ts, "amount": amount, "category": "c", "merchant": "m",
            "city": "x", "country": "US", "channel": "online", "is_fraud": False}


def test_arrays_objects_and_broken_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([rec(1), rec(2)], indent=2))
    (tmp_path / "b.json").write_text(json.dumps(rec(3)))
    (tmp_path / "c.json").write_text('[{"txn_id": "4", ')
    (tmp_path / "d.json").write_text("  \n")
    (tmp_path / "e.json").write_text("[]")
    got = bronze.read_json_records(spark, str(tmp_path), layout="file")
    assert got.columns == ["record", "src_file", "ingested_at"]
    rows = silver.typed(got, silver.TRANSACTION_FIELDS).select("txn_id").collect()
    assert sorted(r["txn_id"] for r in rows) == ["1", "2", "3"]
    assert all(r["src_file"].endswith((".json")) for r in got.select("src_file").collect())
    bad = bronze.split_bad(bronze.read_json_text(spark, str(tmp_path), "file"))[1]
    assert [r["src_file"].split("/")[-1] for r in bad.collect()] == ["c.json"]


def test_unconvertible_fields_become_null(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{**rec(1), "amount": "many", "ts": "soon"}]))
    row = silver.silver_transactions(bronze.read_json_records(spark, str(tmp_path))).first()
    assert row["amount"] is None and row["txn_ts"] is None and row["txn_id"] == "1"


def test_unknown_layout(spark, tmp_path):
    with pytest.raises(ValueError):
        bronze.read_json_text(spark, str(tmp_path), "pages")


def test_append_fills_defaults_and_matches_by_name(spark):
    spark.sql("DROP TABLE IF EXISTS t_append")
    base = spark.createDataFrame([("A", "1")], "ticker string, payload string")
    defaults = {"source": F.lit("feed")}
    tables.append_by_name(base, "t_append", defaults)
    tables.append_by_name(base.select("payload", "ticker"), "t_append", defaults)
    assert [tuple(r) for r in spark.table("t_append").collect()] == [("A", "1", "feed")] * 2
    fresh = spark.createDataFrame([("s", "p", "T")], "source string, payload string, ticker string")
    tables.reload(fresh, "t_append")
    assert [tuple(r) for r in spark.table("t_append").collect()] == [("T", "p", "s")]
    assert tables.ctas(spark, "t_ctas", "SELECT 1 AS x").count() == 1


def test_partition_overwrite_leaves_other_days(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "x int, dt string"), path, "dt")
    tables.overwrite_partitions(spark.createDataFrame([(9, "b")], "x int, dt string"), path, "dt")
    assert sorted((r["x"], r["dt"]) for r in spark.read.parquet(path).collect()) == [(1, "a"), (9, "b")]


def test_ticker_list():
    assert jobs.ticker_list(" aapl, ,MSFT,,gs ") == ["AAPL", "MSFT", "GS"]


def test_whole_lane_from_raw_tables_to_views(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS bronze")
    as_of = dt.date(2024, 3, 1)
    days = [as_of - dt.timedelta(days=i) for i in range(70)]
    bars = spark.createDataFrame(
        [(t, dt.datetime.combine(d, dt.time(0)), 10.0, 12.0, 9.0, 10.0 + (d.day % 5), 100 + d.day) for t in ("A", "B") for d in days],
        "ticker string, ts timestamp_ntz, open double, high double, low double, close double, volume long",
    )
    market = bronze.land_market(bronze.pack_chart(bars))
    tables.overwrite(market, "bronze.raw_market")
    stamp = F.lit("2024-03-01").cast("timestamp_ntz").alias("ingested_at")
    txns = [json.dumps(rec(i, 5.0 + i % 7, f"{days[i % 70]}T03:00:00")) for i in range(700)]
    raw = lambda rows: spark.createDataFrame([(r,) for r in rows], "j string").select(F.parse_json("j").alias("record"), stamp)
    tables.overwrite(raw(txns + txns[:10]), "bronze.raw_transactions")
    news = [json.dumps({"news_id": str(i), "ts": f"{days[i]}T08:00:00", "ticker": "AB"[i % 2], "headline": "A beats estimates",
                        "body": "Strong growth. Shares gain.", "source": "s"}) for i in range(20)]
    tables.overwrite(raw(news), "bronze.raw_news")

    assert jobs.build_silver(spark, "bronze.raw_market", "bronze.raw_transactions", "bronze.raw_news") == (
        "SILVER built: market=140 txns=700 news=20"
    )
    assert jobs.build_gold(spark) == "GOLD built: market_daily=140 spend_daily=70"
    jobs.build_models(spark, as_of)
    names = jobs.register_views(spark, as_of)
    assert len(names) == 21
    rows = {n: spark.table(n).count() for n in names}
    assert rows["v_market_latest"] == 2 and rows["v_spend_trend"] == 70 and rows["v_spend_forecast"] == 14
    assert rows["v_price_forecast"] == 14 and rows["v_news_feed"] == 20 and rows["v_spend_kpis"] == 1
    assert rows["v_news_themes"] == 2 and rows["v_spend_insight"] == 1 and rows["v_spend_anomalies"] == 31
    assert spark.table("v_spend_insight").first()["insight"].count("\n") == 2


def test_typed_quarantine_names_the_field(spark, tmp_path):
    lines = [json.dumps([rec(1), {**rec(2), "amount": "many", "ts": "soon"}]), json.dumps({**rec(3), "is_fraud": "perhaps", "extra": 1}), '{"txn_id": "4", "amo', "[1, 2]", "", json.dumps({"txn_id": None}), json.dumps({**rec(5), "amount": None, "ts": {"a": 1}})]
    (tmp_path / "a.json").write_text("\n".join(lines))
    raw = bronze.read_with_schema(spark, str(tmp_path), silver.TRANSACTION_FIELDS)
    good, bad = bronze.split_typed(raw, silver.TRANSACTION_FIELDS)
    got = {(r.record_key, r.field, r.value) for r in bad.where("field != '_corrupt_record'").collect()}
    assert got == {("2", "amount", "many"), ("2", "txn_ts", "soon"), ("3", "is_fraud_label", "perhaps"), ("5", "txn_ts", '{"a": 1}')}
    assert '{"txn_id": "4", "amo' in {r.value for r in bad.where("field = '_corrupt_record'").collect()}
    typed = {r.txn_id: r for r in good.collect() if r.txn_id}
    assert set(typed) == {"1", "2", "3", "5"} and typed["2"].amount is None and typed["1"].amount == 1.0
    assert good.columns == [f for f, _, _ in silver.TRANSACTION_FIELDS] + ["src_file"]


def test_counts_come_from_footers(spark, tmp_path):
    df = spark.range(1000).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("d"), F.col("id").alias("n"))
    df.write.parquet(str(tmp_path / "t"))
    df.where("false").write.parquet(str(tmp_path / "e"))
    out = tables.footer_counts(spark, {"t": str(tmp_path / "t"), "e": str(tmp_path / "e")}, {"t": "d", "e": "n"})
    assert out._jdf.queryExecution().executedPlan().toString().count("PushedAggregation: [COUNT(*), MIN(") == 2
    assert sorted(map(tuple, out.collect())) == [("e", 0, None, None), ("t", 1000, "2024-01-01", "2024-02-19")]
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
