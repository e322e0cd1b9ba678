"""Gives the parquet test tables the shapes the pipeline works on.

Each adapter is a plain projection (or one dimension join) over the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import case_map, joined_text
from ledgerlake.operators.skew import spread

TXN_AS_OF = "2024-01-31"
# The last trading day itself, so that the latest and the previous close differ.
MARKET_AS_OF = "2024-01-30"
LONG_AS_OF = "2001-08-01"

# Event types in name order, used as tickers for the news lane.
TICKERS = ["click", "error", "purchase", "signup", "view"]
# Foreign country by k mod 5.
FOREIGN = {0: "NG", 1: "RU", 2: "CN", 3: "BR", 4: "RO"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def read_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a file stream, whether it is one file or a folder of files."""
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn_from_events(read(spark, sf_dir, "events"))


def txn_from_events(events: DataFrame) -> DataFrame:
    """Card transactions from `events`, batch or stream."""
    return events.withColumn("k", _k()).select(
        F.col("event_id").cast("string").alias("txn_id"),
        joined_text("ACCT", F.col("user_id").cast("string")).alias("account_id"),
        F.col("ts").alias("txn_ts"),
        F.round(F.col("value") * 10, 2).alias("amount"),
        F.col("event_type").alias("category"),
        joined_text("Merchant ", F.col("k").cast("string")).alias("merchant"),
        joined_text("City ", (F.col("user_id") % 80).cast("string")).alias("city"),
        F.when(F.col("k") < 10, case_map(F.col("k") % 5, FOREIGN)).otherwise("US").alias("country"),
        F.when(F.col("k") % 3 == 0, "online").otherwise("in_store").alias("channel"),
        (F.col("k") < 2).alias("is_fraud_label"),
    )


def txn_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six and a half years of spend: `orders` with customer segment and nation."""
    o = read(spark, sf_dir, "orders")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select(
        F.col("o_orderkey").cast("string").alias("txn_id"),
        F.col("o_custkey").cast("string").alias("account_id"),
        F.col("o_orderdate").alias("txn_ts"),
        F.col("o_totalprice").alias("amount"),
        F.col("c_mktsegment").alias("category"),
        F.col("o_orderpriority").alias("merchant"),
        joined_text("City ", F.col("c_nationkey").cast("string")).alias("city"),
        F.col("n_name").alias("country"),
        F.when(F.col("o_orderstatus") == "O", "online").otherwise("in_store").alias("channel"),
        F.lit(False).alias("is_fraud_label"),
    )


def polled_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles as a poll payload holds them: stamps in whole seconds, so one per ticker and second.

    The largest event_id wins. Only payloads are made from these; everything else reads candles().
    """
    e = read(spark, sf_dir, "events")
    # Only fixed-width values are aggregated, so this is a hash aggregate with map-side combine.
    last = e.groupBy(
        F.col("event_type").alias("ticker"),
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts"),
    ).agg(
        F.max("event_id").alias("event_id"),
        F.max_by("value", "event_id").alias("open"),
        F.max_by("user_id", "event_id").alias("user_id"),
        F.max_by("ts", "event_id").alias("ingested_at"),
    )
    return _candle(last)


def candles_from_events(events: DataFrame) -> DataFrame:
    """One candle per event with its full time stamp, batch or stream."""
    named = events.withColumnsRenamed({"event_type": "ticker", "value": "open"})
    return _candle(named.withColumn("ingested_at", F.col("ts")))


def raw_bars(events: DataFrame) -> DataFrame:
    return candles_from_events(events).drop("ingested_at", "event_id")


def candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market candles from `events`, every event one."""
    return candles_from_events(read(spark, sf_dir, "events"))


def _candle(df: DataFrame) -> DataFrame:
    step = ((F.col("event_id") % 7) - 3) / F.lit(100.0)
    return df.withColumn("close", F.round(F.col("open") * (1 + step), 4)).select(
        "ticker",
        "ts",
        "open",
        F.greatest("open", "close").alias("high"),
        F.least("open", "close").alias("low"),
        "close",
        (F.col("user_id") + 1).alias("volume"),
        "ingested_at",
        "event_id",
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles in the silver price shape."""
    return candles(spark, sf_dir).drop("event_id")


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return news_from_documents(spread(read(spark, sf_dir, "documents")))


def news_from_documents(documents: DataFrame) -> DataFrame:
    """Articles from `documents`; the headline is the text's first line, the body all of it."""
    return documents.select(
        F.col("doc_id").cast("string").alias("news_id"),
        F.timestamp_add("DAY", (F.col("doc_id") % 30).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz"))
        .cast("timestamp_ntz")
        .alias("published_at"),
        case_map(F.col("doc_id") % 5, dict(enumerate(TICKERS))).alias("ticker"),
        F.substring_index("text", "\n", 1).alias("headline"),
        F.col("text").alias("body"),
        "source",
    )


def ship_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily shipped quantity per return flag, as a multi-series (series, ts, y) table."""
    li = read(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_returnflag").alias("series"), F.col("l_shipdate").alias("ts")).agg(
        F.sum("l_quantity").alias("y")
    )
