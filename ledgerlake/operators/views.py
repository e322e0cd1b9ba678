"""Serving views and dashboard queries over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import AsOf, as_date, days_before, div0

# ---- market -----------------------------------------------------------------


def latest_per_key(prices: DataFrame, keyed: bool = False) -> DataFrame:
    """Newest candle per ticker; of equal stamps the one with the largest close, then volume.

    Each step orders by one fixed-width column, so all are hash aggregates. With `keyed` rows (one
    per ticker and stamp) the last step is enough.
    """
    rows = prices.select("ticker", "ts", "close", "volume")
    if not keyed:
        rows = rows.groupBy("ticker", "ts", "close").agg(F.max("volume").alias("volume"))
        rows = rows.groupBy("ticker", "ts").agg(F.max_by("volume", "close").alias("volume"), F.max("close").alias("close"))
    return rows.groupBy("ticker").agg(
        F.max_by("close", "ts").alias("close"),
        F.max_by("volume", "ts").alias("volume"),
        F.max("ts").alias("ts"),
    )


def prev_close(daily: DataFrame, as_of: AsOf) -> DataFrame:
    """Close of the last trading day before `as_of`."""
    return (
        daily.where(F.col("trade_date") < F.lit(as_date(as_of)))
        .groupBy("ticker")
        .agg(F.max_by("close", "trade_date").alias("prev_close"))
    )


def market_latest(prices: DataFrame, daily: DataFrame, as_of: AsOf, keyed: bool = False) -> DataFrame:
    """Last price with the change against the previous close.

    When the newest candle is older than `as_of`, both prices are from the same day.
    """
    j = latest_per_key(prices, keyed).join(prev_close(daily, as_of), "ticker", "left")
    change = F.col("close") - F.col("prev_close")
    return j.select(
        "ticker",
        F.col("close").alias("last_price"),
        "prev_close",
        change.alias("day_change"),
        (div0(change, F.col("prev_close")) * 100).alias("day_change_pct"),
        F.col("volume").alias("last_volume"),
        F.col("ts").alias("as_of"),
    )


def market_intraday(prices: DataFrame) -> DataFrame:
    return prices.select("ticker", "ts", "open", "high", "low", "close", "volume")


def breadth(latest: DataFrame) -> DataFrame:
    """Advancing tickers of all tickers; an unknown change counts as advancing."""
    return latest.agg(
        F.count_if(F.coalesce("day_change_pct", F.lit(0.0)) >= 0).alias("advancers"),
        F.count("*").alias("total"),
    )


def movers(latest: DataFrame, n: int = 3) -> DataFrame:
    """The n best and n worst tickers by day change, ranked within each side."""
    pct = F.round("day_change_pct", 2).alias("pct")

    def side(name: str, order) -> DataFrame:
        top = latest.orderBy(order, "ticker").limit(n)
        rank = F.row_number().over(Window.orderBy(order, "ticker"))  # n rows at most
        return top.select(F.lit(name).alias("side"), rank.alias("rank"), "ticker", pct)

    return side("gainer", F.desc_nulls_last("day_change_pct")).unionByName(
        side("loser", F.asc_nulls_last("day_change_pct"))
    )


def candles(daily: DataFrame, ticker: str) -> DataFrame:
    return (
        daily.where(F.col("ticker") == ticker)
        .select("trade_date", "open", "high", "low", "close", "volume",
                (F.col("open") <= F.col("close")).alias("up"))
        .orderBy(F.asc_nulls_last("trade_date"))
    )


def returns_heatmap(daily: DataFrame) -> DataFrame:
    return daily.where(F.col("daily_return").isNotNull()).select("ticker", "trade_date", "daily_return")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).dropna().distinct().orderBy(col)


def densify(dim: DataFrame, spine: DataFrame) -> DataFrame:
    """Every dimension row on every date of a spine.

    The spine is a calendar (one row per day), so it is folded into a single array and
    exploded per dimension row; no join is needed.
    """
    days = spine.agg(F.sort_array(F.collect_list("d")).alias("_days"))
    return dim.withColumn("_days", days.scalar()).select(*dim.columns, F.explode("_days").alias("d"))


# ---- spend ------------------------------------------------------------------


def spend_kpis(spend_daily: DataFrame, as_of: AsOf) -> DataFrame:
    """30-day spend against the 30 days before, in one pass over the mart.

    "Last 30 days" has no upper bound and includes `as_of`; the earlier window has 30 dates.
    """
    recent = F.col("spend_date") >= days_before(as_of, 30)
    k = (
        spend_daily.where(F.col("spend_date") >= days_before(as_of, 60))
        .agg(
            F.sum(F.when(recent, F.col("total_spend"))).alias("spend_30d"),
            F.sum(F.when(recent, F.col("txn_count"))).alias("txns_30d"),
            F.avg(F.when(recent, F.col("avg_ticket"))).alias("avg_ticket_30d"),
            F.sum(F.when(~recent, F.col("total_spend"))).alias("_prior"),
        )
    )
    growth = div0(F.col("spend_30d") - F.col("_prior"), F.col("_prior")) * 100
    return k.select("spend_30d", "txns_30d", "avg_ticket_30d", growth.alias("spend_mom_pct"))


def daily_avg_spend(kpis: DataFrame) -> DataFrame:
    return kpis.select((F.coalesce("spend_30d", F.lit(0.0)) / 30).alias("daily_avg_spend"))


def spend_trend(spend_daily: DataFrame) -> DataFrame:
    return spend_daily.select("spend_date", "total_spend", "txn_count", "avg_ticket")


def category_share(by_category: DataFrame, as_of: AsOf) -> DataFrame:
    return (
        by_category.where(F.col("spend_date") >= days_before(as_of, 30))
        .groupBy("category")
        .agg(F.sum("total_spend").alias("total_spend"), F.sum("txn_count").alias("txn_count"))
    )


def category_trend(by_category: DataFrame) -> DataFrame:
    return by_category.select("spend_date", "category", "total_spend")


# ---- news -------------------------------------------------------------------


def sentiment_daily(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("ticker", F.to_date("published_at").alias("d")).agg(
        F.avg("sentiment_score").alias("avg_sentiment")
    )


def price_vs_sentiment(daily: DataFrame, enriched: DataFrame) -> DataFrame:
    mood = sentiment_daily(enriched).withColumnRenamed("d", "trade_date")
    return daily.join(mood, ["ticker", "trade_date"], "left").select(
        "ticker", "trade_date", "close", "avg_sentiment"
    )


def sentiment_summary(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("sentiment_label").agg(
        F.count("*").alias("n"), F.round(F.avg("sentiment_score"), 3).alias("avg_score")
    )


def news_feed(enriched: DataFrame) -> DataFrame:
    return enriched.select(
        "published_at", "ticker", "headline", "summary", "sentiment_label", "sentiment_score"
    )


def newest(df: DataFrame, col: str, n: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(col), tie).limit(n)


def sentiment_mix(enriched: DataFrame, n: int = 200) -> DataFrame:
    """Label counts over the newest n articles."""
    recent = newest(enriched.select("news_id", "published_at", "sentiment_label"), "published_at", n, "news_id")
    return recent.groupBy("sentiment_label").agg(F.count("*").alias("n"))


# ---- audit ------------------------------------------------------------------


def audit_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(t).alias("t"), "n_rows") for t, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def audit_values(measured: dict[str, tuple[DataFrame, str | None, str | None]]) -> DataFrame:
    """(t, n_rows, total, letters) per table: rows, sum of a number and length of a text over all of them.

    measured: for each table the SQL expressions of the number and of the text, None where it has none.
    """
    parts = [
        df.agg(
            F.count("*").alias("n_rows"),
            F.round(F.coalesce(F.sum(F.expr(f"CAST({number or 0} AS DOUBLE)")), F.lit(0.0)), 2).alias("total"),
            F.coalesce(F.sum(F.length(F.expr(text or "''"))), F.lit(0)).cast("long").alias("letters"),
        ).select(F.lit(name).alias("t"), "n_rows", "total", "letters")
        for name, (df, number, text) in measured.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
