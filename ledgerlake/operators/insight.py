"""Short texts and evidence tables derived from the marts by fixed rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import AsOf, days_before, money
from ledgerlake.functions.tokens import tokens
from ledgerlake.operators.skew import lookup_join
from ledgerlake.operators.views import movers


def spend_insight(scored: DataFrame, as_of: AsOf, days: int = 7, risky_score: int = 2) -> DataFrame:
    """Three bullets on the last `days`: leading category, biggest riser, risky patterns."""
    day = F.to_date("txn_ts")
    now = day >= days_before(as_of, days)
    window = scored.where(day >= days_before(as_of, 2 * days))
    by_cat = window.groupBy("category").agg(
        F.coalesce(F.sum(F.when(now, F.col("amount"))), F.lit(0.0)).alias("spend"),
        F.coalesce(F.sum(F.when(~now, F.col("amount"))), F.lit(0.0)).alias("before"),
        F.count_if(now & (F.col("rule_score") >= risky_score)).alias("risky"),
    )
    spend = F.round("spend", 2).alias("v")
    rise = F.round(F.col("spend") - F.col("before"), 2).alias("v")
    top = by_cat.agg(
        F.max(F.struct(spend, F.col("category").alias("c"))).alias("top"),
        F.max(F.struct(rise, F.col("category").alias("c"))).alias("riser"),
        F.sum("spend").alias("total"),
        F.sum("risky").alias("risky_txns"),
    )
    share = F.round(
        F.when(F.col("total") == 0, F.lit(0.0)).otherwise(F.col("top.v") / F.col("total") * 100), 1
    )
    facts = top.select(
        F.col("top.c").alias("top_category"),
        share.alias("top_share_pct"),
        F.col("riser.c").alias("riser_category"),
        F.col("riser.v").alias("riser_change"),
        "risky_txns",
    )
    bullets = F.concat(
        F.lit("- "), "top_category", F.lit(" leads with "), money(F.col("top_share_pct"), 1),
        F.lit("% of spend.\n- "), "riser_category", F.lit(" moved most against the week before: "),
        money(F.col("riser_change")), F.lit(".\n- "), F.col("risky_txns").cast("string"),
        F.lit(" transactions match at least two risk patterns."),
    )
    return facts.withColumn("insight", bullets)


def theme_stats(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("ticker").agg(
        F.count("*").alias("articles"), F.round(F.avg("sentiment_score"), 3).alias("avg_sentiment")
    )


def top_terms(news: DataFrame, n: int = 3) -> DataFrame:
    """(ticker, terms): the n headline terms with the highest tf * ln(1 + N / df)."""
    heads = news.select("ticker", F.explode(F.array_distinct(tokens(F.col("headline")))).alias("term"))
    per_ticker = heads.groupBy("ticker", "term").agg(F.count("*").alias("tf"))
    total = news.agg(F.count("*")).scalar()
    # One row per ticker and term here, so a term's window is as small as the ticker list.
    df = F.sum("tf").over(Window.partitionBy("term"))
    weight = F.round(F.col("tf") * F.log(F.lit(1.0) + total / F.col("df")), 6)
    weighted = per_ticker.withColumn("df", df).withColumn("weight", weight)
    best = Window.partitionBy("ticker").orderBy(F.desc("weight"), F.asc("term"))
    top = weighted.withColumn("r", F.row_number().over(best)).where(F.col("r") <= n)
    return top.groupBy("ticker").agg(
        F.array_sort(F.collect_list(F.struct("r", "term", "weight"))).alias("terms")
    )


def news_themes(enriched: DataFrame) -> DataFrame:
    """Articles, mean sentiment and a two-sentence narrative per ticker."""
    terms = top_terms(enriched)
    heads = enriched.where(F.col("headline").isNotNull()).select(
        "ticker", "news_id", "published_at", "headline",
        F.array_distinct(tokens(F.col("headline"))).alias("words"),
    )
    placed = lookup_join(heads, terms, ["ticker"], spread_by="news_id")
    shared = F.filter("terms", lambda t: F.array_contains("words", t["term"]))
    central = F.round(F.aggregate(shared, F.lit(0.0), lambda s, t: s + t["weight"]), 6)
    rank = Window.partitionBy("ticker").orderBy(
        F.desc("central"), F.desc_nulls_last("published_at"), F.asc("news_id")
    )
    ranked = (
        placed.select("ticker", "news_id", "published_at", "headline", central.alias("central"))
        .withColumn("r", F.row_number().over(rank))
        .where(F.col("r") <= 2)
    )
    lead = ranked.groupBy("ticker").agg(
        F.array_sort(F.collect_list(F.struct("r", "headline"))).alias("heads")
    )
    stats = theme_stats(enriched)
    words = F.array_join(F.transform("terms", lambda t: t["term"]), ", ")
    titles = F.array_join(F.transform("heads", lambda h: h["headline"]), "; ")
    narrative = F.concat(
        F.lit("Coverage turns on "), words, F.lit(". Leading headlines: "), titles, F.lit(".")
    )
    return stats.join(terms, "ticker", "left").join(lead, "ticker", "left").select(
        "ticker", "articles", "avg_sentiment", narrative.alias("narrative")
    )


def _listed(rows: DataFrame, order: str, text: Column, sep: str) -> Column:
    """One string from a frame of a few rows, as a scalar subquery."""
    items = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), text.alias("x"))))
    return rows.agg(F.array_join(F.transform(items, lambda i: i["x"]), sep)).scalar()


def daily_brief(
    latest: DataFrame, kpis: DataFrame, flagged: DataFrame, themes: DataFrame, n_themes: int = 5
) -> DataFrame:
    """Movers, spend, flagged transactions and themes in one row with a markdown text."""
    moved = movers(latest)
    label = F.concat("ticker", F.lit(" "), money(F.col("pct")), F.lit("%"))
    first = themes.orderBy("ticker").limit(n_themes)
    theme = F.concat(F.lit("- "), "ticker", F.lit(": "), "narrative")
    facts = kpis.select(
        _listed(moved.where("side = 'gainer'"), "rank", label, ", ").alias("gainers"),
        _listed(moved.where("side = 'loser'"), "rank", label, ", ").alias("losers"),
        F.round("spend_30d", 2).alias("spend_30d"),
        F.round("spend_mom_pct", 1).alias("spend_mom_pct"),
        flagged.agg(F.count("*")).scalar().alias("flagged"),
        _listed(first, "ticker", theme, "\n").alias("themes"),
    )
    brief = F.concat(
        F.lit("## Markets\nTop gainers: "), "gainers", F.lit("\nTop losers: "), "losers",
        F.lit("\n## Spending\n30-day spend $"), money(F.col("spend_30d"), 0),
        F.lit(", "), money(F.col("spend_mom_pct"), 1), F.lit("% against the 30 days before\n## Risk\n"),
        F.col("flagged").cast("string"), F.lit(" flagged transactions\n"), "themes",
    )
    return facts.withColumn("brief", brief)


def movers_with_news(
    latest: DataFrame, find: Callable[..., DataFrame], question: str, n: int = 3, k: int = 5, columns: list[str] | None = None
) -> DataFrame:
    """The n worst movers with the k articles about each that best match a question.

    find(queries, k, columns) is a search, such as segments.search over a stored index.
    """
    worst = movers(latest, n).where("side = 'loser'")
    queries = worst.select(F.col("ticker").alias("query_id"), "ticker", F.lit(question).alias("query"))
    found = find(queries, k, columns)
    keep = [c for c in found.columns if c not in ("query_id", "rank", "ticker")]
    return worst.select("ticker", "pct").join(
        found.select(F.col("query_id").alias("ticker"), F.col("rank").alias("news_rank"), *keep), "ticker", "left"
    )
