"""Batch jobs: landing by ticker list, silver build, gold build, and view registration."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import AsOf
from ledgerlake.operators import fraud, gold, insight, series, silver, text, vectors, views
from ledgerlake.sources import bronze
from ledgerlake.sources.tables import append_by_name, overwrite


def ticker_list(tickers_csv: str) -> list[str]:
    return [t for t in (p.strip().upper() for p in tickers_csv.split(",")) if t]


def land_market_for(payloads: DataFrame, tickers_csv: str, table: str | None = None, source: str = "yahoo") -> DataFrame:
    """Land the payloads of the listed tickers; also appended to `table` when given."""
    landed = bronze.land_market(payloads.where(F.col("ticker").isin(ticker_list(tickers_csv))), source)
    if table:
        append_by_name(landed, table)
    return landed


def build_silver(
    spark: SparkSession, raw_market: str, raw_transactions: str, raw_news: str, schema: str = "silver"
) -> str:
    """Rebuild the three typed tables; counts come from the written tables."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    market = overwrite(silver.silver_market(spark.table(raw_market)), f"{schema}.market_prices")
    txn = overwrite(silver.silver_transactions(spark.table(raw_transactions)), f"{schema}.transactions")
    news = overwrite(silver.silver_news(spark.table(raw_news)), f"{schema}.news_articles")
    return f"SILVER built: market={market.count()} txns={txn.count()} news={news.count()}"


def build_gold(spark: SparkSession, silver_schema: str = "silver", schema: str = "gold") -> str:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    txn = spark.table(f"{silver_schema}.transactions")
    daily = overwrite(gold.market_daily(spark.table(f"{silver_schema}.market_prices"), keyed=True), f"{schema}.market_daily")
    spend = overwrite(gold.spend_daily(txn), f"{schema}.spend_daily")
    overwrite(gold.spend_by_category(txn), f"{schema}.spend_by_category")
    overwrite(gold.txn_features(txn), f"{schema}.txn_features")
    overwrite(gold.gold_news(spark.table(f"{silver_schema}.news_articles")), f"{schema}.news")
    return f"GOLD built: market_daily={daily.count()} spend_daily={spend.count()}"


def build_models(spark: SparkSession, as_of: AsOf, schema: str = "gold", **lexicon) -> None:
    """Tables derived by scoring: enrichment, fraud, anomalies and forecasts."""
    t = lambda name: spark.table(f"{schema}.{name}")
    overwrite(text.enrich_news(t("news"), **lexicon), f"{schema}.news_enriched")
    overwrite(fraud.rule_score(t("txn_features")), f"{schema}.fraud_candidates")
    scored = overwrite(fraud.score_fraud(t("fraud_candidates")), f"{schema}.fraud_scored")
    overwrite(fraud.explain_fraud(scored), f"{schema}.fraud_explained")
    pool = vectors.vector_pool(t("fraud_scored"), t("txn_features"))
    overwrite(vectors.embed(pool, "txn_text"), f"{schema}.txn_vectors")
    spend, volume = series.spend_series(t("spend_daily")), series.volume_series(t("market_daily"))
    overwrite(series.detect_anomalies(*series.split_series(spend, as_of)), f"{schema}.spend_anomalies")
    overwrite(series.detect_anomalies(*series.split_series(volume, as_of)), f"{schema}.volume_anomalies")
    overwrite(series.spend_forecast_view(series.forecast(spend, 14)), f"{schema}.spend_forecast")
    prices = series.price_series(t("market_daily"))
    overwrite(series.price_forecast_view(series.forecast(prices, 7)), f"{schema}.price_forecast")


def view_plans(spark: SparkSession, as_of: AsOf, silver_schema: str = "silver", schema: str = "gold") -> dict[str, Callable[[], DataFrame]]:
    t = lambda name: spark.table(f"{schema}.{name}")
    prices = lambda: spark.table(f"{silver_schema}.market_prices")
    spend = lambda: series.spend_series(t("spend_daily"))
    volume = lambda: series.volume_series(t("market_daily"))
    return {
        "v_market_latest": lambda: views.market_latest(prices(), t("market_daily"), as_of, keyed=True),
        "v_market_intraday": lambda: views.market_intraday(prices()),
        "v_spend_kpis": lambda: views.spend_kpis(t("spend_daily"), as_of),
        "v_spend_trend": lambda: views.spend_trend(t("spend_daily")),
        "v_category_share": lambda: views.category_share(t("spend_by_category"), as_of),
        "v_spend_series": spend,
        "v_volume_series": volume,
        "v_price_series": lambda: series.price_series(t("market_daily")),
        "v_spend_train": lambda: series.split_series(spend(), as_of)[0],
        "v_spend_eval": lambda: series.split_series(spend(), as_of)[1],
        "v_volume_train": lambda: series.split_series(volume(), as_of)[0],
        "v_volume_eval": lambda: series.split_series(volume(), as_of)[1],
        "v_spend_anomalies": lambda: series.spend_anomaly_view(t("spend_anomalies")),
        "v_volume_anomalies": lambda: series.volume_anomaly_view(t("volume_anomalies")),
        "v_fraud_flagged": lambda: fraud.fraud_flagged(t("fraud_explained")),
        "v_spend_forecast": lambda: t("spend_forecast"),
        "v_price_forecast": lambda: t("price_forecast"),
        "v_news_feed": lambda: views.news_feed(t("news_enriched")),
        "v_price_vs_sentiment": lambda: views.price_vs_sentiment(t("market_daily"), t("news_enriched")),
        "v_spend_insight": lambda: insight.spend_insight(t("fraud_candidates"), as_of),
        "v_news_themes": lambda: insight.news_themes(t("news_enriched")),
    }


def register_views(spark: SparkSession, as_of: AsOf, **schemas: str) -> list[str]:
    """Register the 21 serving views over the built tables as temp views."""
    plans = view_plans(spark, as_of, **schemas)
    for name, plan in plans.items():
        plan().createOrReplaceTempView(name)
    return list(plans)
