"""What a batch of the chained refresh rewrites, and that the result is that of all versions at once."""

import datetime as dt
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from ledgerlake.operators import gold, silver
from ledgerlake.sources import bronze
from ledgerlake.streaming import ingest, marts

COLUMNS = marts.TRANSACTIONS.typed_schema


def batch(spark, rows):
    """(txn_id, account, day or None, amount, minute of arrival)"""
    made = [
        (i, a, None if d is None else dt.datetime(2024, 1, d, 9), x, "c", None, None, None, None, False, dt.datetime(2024, 2, 1, 0, m))
        for i, a, d, x, m in rows
    ]
    return spark.createDataFrame(made, COLUMNS)


def by_day(lake, table="silver"):
    found = {}
    for name, version in lake.state().tables[table].items():
        found.setdefault(name.split("@")[0], set()).add(version)
    return found


def test_new_records_rewrite_no_day(spark, tmp_path):
    lake = marts.Lake(spark, str(tmp_path))
    marts.refresh(batch(spark, [(f"a{i}", "A", 1 + i % 3, 1.0, 1) for i in range(9)]), lake.root)
    first = by_day(lake)
    marts.refresh(batch(spark, [(f"b{i}", "A", 1 + i % 3, 1.0, 2) for i in range(9)]), lake.root)
    assert all(first[d] < v for d, v in by_day(lake).items())
    assert {r.spend_date.day: r.txn_count for r in marts.read_spend_daily(spark, lake.root).collect()} == {1: 6, 2: 6, 3: 6}
    # A correction rewrites its own day only.
    second = by_day(lake)
    marts.refresh(batch(spark, [("a0", "A", 1, 5.0, 3)]), lake.root)
    third = by_day(lake)
    assert [d for d in third if not second[d] <= third[d]] == ["dt=2024-01-01"]
    # Days that took many batches become one version again.
    for n in range(2 * marts.VERSIONS):
        marts.refresh(batch(spark, [(f"x{n}", "A", 2, 1.0, 9)]), lake.root)
        assert max(map(len, [*by_day(lake).values(), *by_day(lake, "keys").values()])) <= marts.VERSIONS
    assert marts.read_silver(spark, lake.root).count() == 18 + 2 * marts.VERSIONS


@pytest.mark.parametrize("few", [0, 200_000])
def test_batches_give_what_all_versions_give(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(marts, "BROADCAST_KEYS", few)
    rows = [[(None if i % 11 == 5 else f"t{(i * 7 + b * 3) % 30}", f"A{i % 3}", (None, 1, 2, 3, 4)[(i + b) % 5], float(i + b), (i * 13 + b * 5) % 50) for i in range(20)] for b in range(3)]
    for part in rows:
        marts.refresh(batch(spark, part), str(tmp_path))
    every = silver.latest_version(batch(spark, sum(rows, [])), ["txn_id"], ["ingested_at", "txn_ts"])
    plain = lambda df: sorted(map(str, df.collect()))
    assert plain(marts.read_silver(spark, str(tmp_path)).drop("dt")) == plain(every)
    spend = gold.spend_daily(every).select("txn_count", "total_spend", "avg_ticket", "spend_date")
    assert plain(marts.read_spend_daily(spark, str(tmp_path))) == plain(spend)
    assert plain(marts.read_account_means(spark, str(tmp_path))) == plain(gold.account_means(every))
    marts.forget_days(spark, str(tmp_path), [dt.date(2024, 1, 2)])
    left = every.where("txn_ts is null or to_date(txn_ts) != '2024-01-02'")
    assert plain(marts.read_silver(spark, str(tmp_path)).drop("dt")) == plain(left)


def test_records_are_stored_parsed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('[{"txn_id": "1", "amount": "x", "is_fraud": true}, null, 3]\n{"txn_id"\n{"txn_id": 2, "amount": 1.5}\n')
    ingest.stream_bronze(spark, str(tmp_path / "in"), str(tmp_path / "b"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "b")).schema["record"].dataType == VariantType()
    rows = silver.typed(ingest.read_bronze(spark, str(tmp_path / "b")), silver.TRANSACTION_FIELDS)
    got = sorted(map(str, rows.select("txn_id", "amount", F.col("is_fraud_label").alias("f")).collect()))
    assert got == sorted(f"Row(txn_id={i}, amount={a}, f={f})" for i, a, f in (("'1'", None, True), (None, None, None), (None, None, None), ("'2'", 1.5, None)))


def test_a_payload_is_made_and_parsed_once(spark):
    bars = spark.createDataFrame([("a", "2024-01-02 00:00:09", 2.0), ("a", "2024-01-02 00:00:01", 1.0), ("b", "2024-01-02 00:00:05", None)], "ticker string, ts string, close double")
    bars = bars.select("ticker", F.col("ts").cast("timestamp_ntz"), *[F.col("close").alias(c) for c in ("open", "high", "low", "close")], F.lit(1).alias("volume"))
    texts = bronze.pack_chart(bars)
    odd = spark.createDataFrame([("c", ""), ("c", None), ("c", "{"), ("c", "null")], "ticker string, payload_text string")
    landed = bronze.land_market(texts.select("ticker", "payload_text").unionByName(odd))
    plan = bronze.land_market(texts)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StructsToJsonEvaluator(") == 1 and "lambda" not in plan
    assert len(re.findall(r"parse_json\(|parseJson", plan)) == 1  # a filter on the payload made and parsed the text again
    got = landed.select("ticker", F.variant_get("payload", "$.chart.result[0].timestamp", "array<long>").alias("s"), "source").collect()
    assert sorted((r.ticker, len(r.s or []), r.s == sorted(r.s or []), r.source) for r in got) == [("a", 2, True, "yahoo"), ("b", 1, True, "yahoo"), ("c", 0, False, "yahoo")]


def test_stored_texts_are_compressed_well(spark, tmp_path):
    """Raw, typed, silver and mart files hold every text; by Spark's default they took half as much again."""
    lines = ['{"news_id": "%d", "ts": "2024-01-02T09:00:00", "ticker": "a", "headline": "h", "body": "one two", "source": "s"}' % i for i in range(5)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join([*lines, "{cut"]))
    marts.run_medallion(spark, str(tmp_path / "in"), str(tmp_path / "lake"), str(tmp_path / "cp"), marts.NEWS).awaitTermination()
    assert marts.read_news(spark, str(tmp_path / "lake")).count() == 5
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "lake").rglob("*.parquet")]
    used = {m.row_group(g).column(c).compression for m in files for g in range(m.num_row_groups) for c in range(m.num_columns)}
    assert used == {"ZSTD"}
