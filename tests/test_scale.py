"""Plans and results when one key holds a third or more of the rows."""

import datetime as dt

import pytest
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.operators import gold, skew, views
from ledgerlake.plans.queries import REGISTRY
from ledgerlake.sources import adapters

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed_txn(spark, n=30_000):
    hot = F.col("id") % 3 == 0
    return spark.range(n, numPartitions=8).select(
        F.col("id").cast("string").alias("txn_id"),
        F.when(hot, "HOT").otherwise(F.concat(F.lit("A"), (F.col("id") % 5000).cast("string"))).alias("account_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).cast("timestamp_ntz").alias("txn_ts"),
        (F.col("id") % 97).cast("double").alias("amount"),
        F.when(hot, "one").when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 4).cast("string")).alias("category"),
        F.lit("m").alias("merchant"), F.lit("c").alias("city"), F.lit("US").alias("country"),
        F.lit("online").alias("channel"), F.lit(False).alias("is_fraud_label"),
    )


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_features_equal_the_window_definition(spark, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        t = skewed_txn(spark)
        acct, cat = Window.partitionBy("account_id"), Window.partitionBy("account_id", "category")
        want = t.select("txn_id", F.round(F.avg("amount").over(acct), 6).alias("a"),
                        F.round(F.col("amount") / F.nullif(F.avg("amount").over(cat), F.lit(0.0)), 6).alias("r"))
        got = gold.txn_features(t).select("txn_id", F.round("acct_avg_amount", 6).alias("a"), F.round("amt_vs_cat_avg", 6).alias("r"))
        assert got.count() == 30_000
        assert want.exceptAll(got).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_hot_rows_are_spread_before_the_join(spark):
    """No shuffle partition of the stats join holds anything near the hot third."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        t = skewed_txn(spark)
        f = skew.attach_group_stats(t, gold.account_means(t), ["account_id", "category"], "rows", "txn_id")
        sizes = f.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert max(r["count"] for r in sizes) < 1.5 * 30_000 / 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


@pytest.mark.parametrize("limit", [200_000, 0])
def test_lookup_join_on_both_paths(spark, limit):
    rows = spark.range(9_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    lookup = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    got = skew.lookup_join(rows, lookup, ["k"], spread_by="id", max_broadcast_rows=limit)
    assert got.count() == 9_000 and got.where("v <> k * 10").count() == 0


def test_marts_use_hash_aggregates_and_prune_columns(spark):
    p = plan(gold.ohlc_daily(adapters.prices(spark, SF)))
    assert "SortAggregate" not in p
    prices = adapters.prices(spark, SF)
    for keyed in (True, False):
        for df in (gold.ohlc_daily(prices, keyed), views.latest_per_key(prices, keyed), views.market_latest(prices, gold.ohlc_daily(prices, keyed), dt.date(2024, 1, 30), keyed)):
            assert "SortAggregate" not in plan(df)
    p = plan(gold.spend_daily(adapters.txn(spark, SF)))
    assert "props" not in p.split("ReadSchema")[1]


def test_date_filter_is_pushed_to_the_mart(spark, tmp_path):
    path = str(tmp_path / "m")
    gold.spend_by_category(adapters.txn_long(spark, SF)).write.parquet(path)
    p = plan(views.category_share(spark.read.parquet(path), dt.date(2001, 8, 1)))
    assert "GreaterThanOrEqual(spend_date,2001-07-02)" in p


def test_top_k_never_sorts_everything(spark):
    assert "TakeOrderedAndProject" in plan(REGISTRY["fraud_scored"](spark, SF))
    assert "WindowGroupLimit" in plan(REGISTRY["news_search"](spark, SF))


def test_no_cartesian_products(spark):
    for name in ("densify_returns", "spend_kpis", "daily_brief", "news_search", "txn_features", "market_latest"):
        p = plan(REGISTRY[name](spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_broadcasts_are_decided_by_bytes(spark):
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 10_000).alias("t"), F.array_repeat(F.lit(1.0), 1000).alias("v"), F.create_map(F.lit("k"), F.lit("v")).alias("m"))
    assert skew.fits_bytes(wide, 4 << 20) and not skew.fits_bytes(wide, 1 << 20)
    assert skew.fits_bytes(wide.select("id"), 1 << 13) and not skew.fits_bytes(spark.range(10_000), 1 << 13)
    assert not skew.fits_bytes(spark.range(100).select(F.struct(F.col("id"), F.repeat(F.lit("é"), 5000).alias("t")).alias("s")), 1 << 19)
    rows = spark.range(9_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    lookup = spark.range(50).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 100).alias("v"))
    for bound in (1 << 20, 100):
        got = skew.lookup_join(rows, lookup, ["k"], spread_by="id", max_broadcast_bytes=bound, hot_share=8)
        assert got.count() == 9_000
        assert ("SortMergeJoin" in plan(got)) == (bound == 100) or "_salt" in plan(got)
    left = skew.lookup_join(rows, lookup.where("k > 10"), ["k"], spread_by="id", how="left", max_broadcast_bytes=100, hot_share=8)
    assert left.count() == 9_000 and left.where("v is null and k > 10").count() == 0


def test_texts_go_to_python_in_bounded_batches(spark):
    from ledgerlake.session import ARROW_BATCH, prepare

    long = prepare(spark).range(0, 300, 1, 1).select(F.expr("repeat('words ', 30000)").alias("text"))
    size = lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches)
    sizes = [r.n for r in long.mapInArrow(size, "n long").collect()]
    assert sum(sizes) > 6 * ARROW_BATCH and max(sizes) < 2 * ARROW_BATCH
