"""A metric layer: named measures and dimensions over marts, answered by one aggregation."""

from __future__ import annotations

import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names, synonyms and expressions decide which questions resolve.
# name -> {"expr": column or SQL aggregate, "synonyms": [...]}
MODEL = {
    "transactions": {
        "dimensions": {
            "category": {"expr": "category", "synonyms": ["spend category", "merchant category", "type of spend"]},
            "merchant": {"expr": "merchant", "synonyms": ["store", "vendor", "retailer"]},
            "channel": {"expr": "channel", "synonyms": ["payment channel", "online or in person"]},
            "country": {"expr": "country", "synonyms": ["transaction country"]},
            "account_id": {"expr": "account_id", "synonyms": ["cardholder", "customer", "account"]},
        },
        "time": {"txn_ts": {"expr": "txn_ts", "synonyms": ["transaction date", "when", "date"]}},
        "measures": {
            "total_spend": {"expr": "sum(amount)", "synonyms": ["spend", "amount spent", "dollars"]},
            "transaction_count": {"expr": "count(txn_id)", "synonyms": ["number of transactions", "txns", "count"]},
            "avg_ticket": {"expr": "avg(amount)", "synonyms": ["average transaction", "average amount"]},
        },
    },
    "market": {
        "dimensions": {"ticker": {"expr": "ticker", "synonyms": ["stock", "symbol", "company"]}},
        "time": {"trade_date": {"expr": "trade_date", "synonyms": ["date", "trading day"]}},
        "measures": {
            "close_price": {"expr": "avg(close)", "synonyms": ["price", "closing price"]},
            "avg_daily_return": {"expr": "avg(daily_return)", "synonyms": ["return", "daily return", "performance"]},
            "total_volume": {"expr": "sum(volume)", "synonyms": ["volume", "shares traded"]},
        },
    },
    "news": {
        "dimensions": {
            "news_ticker": {"expr": "ticker", "synonyms": ["news stock", "headline ticker"]},
            "sentiment_label": {"expr": "sentiment_label", "synonyms": ["sentiment", "tone"]},
            "topic": {"expr": "topic", "synonyms": ["news topic", "theme"]},
        },
        "time": {"published_at": {"expr": "published_at", "synonyms": ["news date", "published"]}},
        "measures": {
            "article_count": {"expr": "count(news_id)", "synonyms": ["number of articles", "headlines"]},
            "avg_sentiment": {"expr": "avg(sentiment_score)", "synonyms": ["average sentiment", "sentiment score"]},
        },
    },
}

GRAINS = ("day", "week", "month", "quarter", "year")
OPERATORS = {
    "=": operator.eq, "<>": operator.ne, "<": operator.lt, "<=": operator.le,
    ">": operator.gt, ">=": operator.ge, "in": lambda c, v: c.isin(list(v)),
}


def resolve(section: dict, name: str) -> tuple[str, str]:
    """(canonical name, expression) of a name or synonym, in any case."""
    wanted = name.strip().lower()
    for key, item in section.items():
        if wanted == key or wanted in item["synonyms"]:
            return key, item["expr"]
    raise KeyError(f"unknown name {name!r}; known: {sorted(section)}")


def metric_query(
    df: DataFrame,
    table: str,
    measures: Sequence[str],
    dimensions: Sequence[str] = (),
    grain: str | None = None,
    filters: Sequence[tuple[str, str, object]] = (),
    order_by: Sequence[tuple[str, str]] = (),
    limit: int | None = None,
    model: dict = MODEL,
) -> DataFrame:
    """Measures by dimensions and time grain over a mart, from names or synonyms.

    Filters are (dimension or time name, operator, value) and become column comparisons, so
    they reach the scan and no text is ever spliced into SQL.
    """
    spec = model[table]
    by_name = {**spec["dimensions"], **spec["time"]}
    for name, op, value in filters:
        df = df.where(OPERATORS[op](F.col(resolve(by_name, name)[1]), F.lit(value) if op != "in" else value))
    keys: list[Column] = []
    if grain is not None:
        if grain not in GRAINS:
            raise ValueError(f"grain must be one of {GRAINS}")
        (time_name, item), = spec["time"].items()
        keys.append(F.date_trunc(grain, F.col(item["expr"])).cast("date").alias(f"{time_name}_{grain}"))
    for name in dimensions:
        key, expr = resolve(spec["dimensions"], name)
        keys.append(F.col(expr).alias(key))
    aggs = [F.expr(e).alias(k) for k, e in (resolve(spec["measures"], m) for m in measures)]
    out = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    if order_by:
        out = out.orderBy(
            *[F.desc_nulls_last(c) if way == "desc" else F.asc_nulls_last(c) for c, way in order_by]
        )
    return out.limit(limit) if limit is not None else out


def spend_by_category_total(features: DataFrame) -> DataFrame:
    """Categories by total amount, largest first."""
    return metric_query(features, "transactions", ["total_spend"], ["category"],
                        order_by=[("total_spend", "desc"), ("category", "asc")])


def worst_return(market_daily: DataFrame) -> DataFrame:
    """Tickers by mean daily return, lowest first."""
    return metric_query(market_daily, "market", ["avg_daily_return"], ["ticker"]).withColumnRenamed(
        "avg_daily_return", "avg_return"
    ).orderBy(F.asc_nulls_last("avg_return"), "ticker")


def most_negative_news(enriched: DataFrame) -> DataFrame:
    """Tickers by mean sentiment of their articles, lowest first."""
    q = metric_query(enriched, "news", ["avg_sentiment", "article_count"], ["news_ticker"])
    return q.select(
        F.col("news_ticker").alias("ticker"), "avg_sentiment", F.col("article_count").alias("articles")
    ).orderBy(F.asc_nulls_last("avg_sentiment"), "ticker")
