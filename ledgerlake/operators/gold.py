"""Marts over the typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import joined_text, ratio, sunday0
from ledgerlake.operators.skew import attach_group_stats


def per_stamp(prices: DataFrame) -> DataFrame:
    """One candle per ticker and stamp: of repeated stamps the smallest open and the largest close."""
    return prices.groupBy("ticker", "ts").agg(
        F.min("open").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max("close").alias("close"),
        F.sum("volume").alias("volume"),
    )


def ohlc_daily(prices: DataFrame, keyed: bool = False) -> DataFrame:
    """Open, high, low, close and volume per ticker and day.

    Open and close are taken by the stamp alone, which is fixed-width, so this is a hash aggregate.
    That needs one candle per stamp: `keyed` says that the rows are so already, as the typed table's
    are, which combines them before the shuffle; else a first hash aggregate makes them so.
    """
    rows = prices if keyed else per_stamp(prices)
    return rows.groupBy("ticker", F.to_date("ts").alias("trade_date")).agg(
        F.min_by("open", "ts").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "ts").alias("close"),
        F.sum("volume").alias("volume"),
    )


def daily_return(daily: DataFrame) -> DataFrame:
    """Change against the previous available day; a ticker's window holds one row per day."""
    days = Window.partitionBy("ticker").orderBy("trade_date")
    return daily.withColumn(
        "daily_return", ratio(F.col("close"), F.lag("close").over(days)) - 1
    )


def market_daily(prices: DataFrame, keyed: bool = False) -> DataFrame:
    return daily_return(ohlc_daily(prices, keyed))


def spend_daily(txn: DataFrame) -> DataFrame:
    return txn.groupBy(F.to_date("txn_ts").alias("spend_date")).agg(
        F.count("*").alias("txn_count"),
        F.sum("amount").alias("total_spend"),
        F.avg("amount").alias("avg_ticket"),
    )


def spend_by_category(txn: DataFrame) -> DataFrame:
    return txn.groupBy(F.to_date("txn_ts").alias("spend_date"), "category").agg(
        F.count("*").alias("txn_count"),
        F.sum("amount").alias("total_spend"),
    )


def account_sums(txn: DataFrame, places: int = 2) -> DataFrame:
    """Per (account, category): rows, amounts and their exact sum.

    Amounts are summed as decimals of `places` places, so the sums do not depend on how rows are
    spread over tasks, and sums of parts can be added and taken off again.
    """
    amount = F.col("amount").try_cast(f"decimal(28,{places})")
    return txn.groupBy("account_id", "category").agg(
        F.count("*").alias("rows"),
        F.count(amount).alias("n"),
        F.sum(amount).alias("s"),
    )


def means_of(sums: DataFrame) -> DataFrame:
    """Account mean and account-category mean of account_sums(); each is one division."""
    # One row per category of the account, so the window stays as small as the category list.
    account = Window.partitionBy("account_id")
    return sums.select(
        "account_id",
        "category",
        "rows",
        ratio(F.sum("s").over(account).cast("double"), F.sum("n").over(account).cast("double")).alias("acct_avg_amount"),
        ratio(F.col("s").cast("double"), F.col("n").cast("double")).alias("cat_avg"),
    )


def account_means(txn: DataFrame, places: int = 2) -> DataFrame:
    """Per (account, category): row count, account mean and account-category mean."""
    return means_of(account_sums(txn, places))


def txn_features(txn: DataFrame, means: DataFrame | None = None) -> DataFrame:
    """Transactions with hour, weekday, account mean, ratio to the usual amount, and a text.

    The means are aggregated first (or given, where they are kept) and joined back, because a window
    over the account would bring every row of a busy account into one task.
    """
    means = account_means(txn) if means is None else means
    f = attach_group_stats(txn, means, ["account_id", "category"], count_col="rows", spread_by="txn_id")
    return f.select(
        *txn.columns,
        F.hour("txn_ts").alias("txn_hour"),
        sunday0(F.col("txn_ts")).alias("txn_dow"),
        "acct_avg_amount",
        ratio(F.col("amount"), F.col("cat_avg")).alias("amt_vs_cat_avg"),
        joined_text(
            F.col("merchant"), " | ", F.col("category"), " | ", F.col("city"), ", ",
            F.col("country"), " | ", F.col("channel"),
        ).alias("txn_text"),
    )


def gold_news(silver_news: DataFrame) -> DataFrame:
    return silver_news.select("*")


def compound_index(returns: DataFrame, base: float = 100.0) -> DataFrame:
    """Running index base * exp(sum of returns) per ticker over its daily rows."""
    running = (
        Window.partitionBy("ticker")
        .orderBy("trade_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return returns.withColumn("index_level", F.lit(base) * F.exp(F.sum("daily_return").over(running)))
