"""Rule scoring of transactions, the review list, its classification and explanation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import flag, money


def _rules(ratio_gt: float, amount_gt: float, hour_lt: int, include_label: bool) -> dict[str, Column]:
    rules = {
        "odd": F.col("amt_vs_cat_avg") > ratio_gt,
        "big": F.col("amount") > amount_gt,
        "abroad": (F.col("channel") == "online") & (F.col("country") != "US"),
        "night": F.col("txn_hour") < hour_lt,
    }
    # The label is the answer itself; it stays in by default because the scores include it.
    return rules | {"label": F.col("is_fraud_label")} if include_label else rules


def rule_score(
    features: DataFrame,
    ratio_gt: float = 4,
    amount_gt: float = 1000,
    hour_lt: int = 5,
    include_label: bool = True,
) -> DataFrame:
    """Adds the number of rules that fire; an unknown condition does not fire."""
    score = sum((flag(r) for r in _rules(ratio_gt, amount_gt, hour_lt, include_label).values()), F.lit(0))
    return features.withColumn("rule_score", score)


def top_candidates(candidates: DataFrame, n: int = 200) -> DataFrame:
    """Riskiest n: highest score, then newest, then smallest id."""
    return (
        candidates.where(F.col("rule_score") >= 1)
        .orderBy(F.desc_nulls_last("rule_score"), F.desc_nulls_last("txn_ts"), F.asc_nulls_last("txn_id"))
        .limit(n)
    )


def score_fraud(candidates: DataFrame, n: int = 200, min_score: int = 3) -> DataFrame:
    """Classifies the review list by a threshold on the rule score."""
    return top_candidates(candidates, n).withColumn(
        "ai_fraud_class",
        F.when(F.col("rule_score") >= min_score, "Suspicious").otherwise("Legitimate"),
    )


def explain_fraud(
    scored: DataFrame,
    ratio_gt: float = 4,
    amount_gt: float = 1000,
    hour_lt: int = 5,
    include_label: bool = True,
) -> DataFrame:
    """Suspicious rows with the rules that fired, their values and one action.

    The parameters are those of rule_score, so a reason never names a rule that did not count.
    """
    fired = _rules(ratio_gt, amount_gt, hour_lt, include_label)
    odd, big, abroad, night = (fired[k] for k in ("odd", "big", "abroad", "night"))
    reasons = {
        "odd": F.concat(money(F.round("amt_vs_cat_avg", 1), 1), F.lit("x the usual "), F.col("category"), F.lit(" spend")),
        "big": F.concat(F.lit("amount $"), money(F.col("amount"))),
        "abroad": F.concat(F.lit("online from "), F.col("country")),
        "night": F.concat(F.lit("at hour "), F.col("txn_hour").cast("string")),
        "label": F.lit("labelled as fraud"),
    }
    why = F.concat_ws("; ", *[F.when(rule, reasons[name]) for name, rule in fired.items()])
    action = (
        F.when(odd & big, "Block the card and call the cardholder.")
        .when(abroad, "Decline and ask for step-up verification.")
        .when(night, "Hold the transaction for manual review.")
        .otherwise("Monitor the account.")
    )
    return scored.where(F.col("ai_fraud_class") == "Suspicious").withColumn(
        "ai_reason", F.concat(F.lit("Suspicious: "), why, F.lit(". Action: "), action)
    )


def fraud_flagged(explained: DataFrame) -> DataFrame:
    return explained.select(
        "txn_id", "txn_ts", "account_id", "amount", "category", "merchant", "city", "country",
        "channel", F.round("amt_vs_cat_avg", 1).alias("x_usual"), "rule_score", "ai_reason",
    )


def fraud_class_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("ai_fraud_class").agg(F.count("*").alias("n"))


def fraud_class_share(scored: DataFrame) -> DataFrame:
    """Suspicious rows, all reviewed rows and the share in percent (0 when nothing was reviewed)."""
    t = scored.agg(
        F.count("*").alias("total"), F.count_if(F.col("ai_fraud_class") == "Suspicious").alias("suspicious")
    )
    share = F.when(F.col("total") == 0, F.lit(0.0)).otherwise(100.0 * F.col("suspicious") / F.col("total"))
    return t.select("suspicious", "total", share.alias("suspicious_pct"))
