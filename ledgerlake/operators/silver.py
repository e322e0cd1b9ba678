"""Typed, deduplicated tables from raw records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import epoch_to_ntz

CHART_RESULT = (
    "struct<meta:struct<symbol:string>,timestamp:array<bigint>,"
    "indicators:struct<quote:array<struct<open:array<double>,high:array<double>,"
    "low:array<double>,close:array<double>,volume:array<bigint>>>>>"
)

# (output column, field of the raw record, type)
TRANSACTION_FIELDS = [
    ("txn_id", "txn_id", "string"),
    ("account_id", "account_id", "string"),
    ("txn_ts", "ts", "timestamp_ntz"),
    ("amount", "amount", "double"),
    ("category", "category", "string"),
    ("merchant", "merchant", "string"),
    ("city", "city", "string"),
    ("country", "country", "string"),
    ("channel", "channel", "string"),
    ("is_fraud_label", "is_fraud", "boolean"),
]
NEWS_FIELDS = [
    ("news_id", "news_id", "string"),
    ("published_at", "ts", "timestamp_ntz"),
    ("ticker", "ticker", "string"),
    ("headline", "headline", "string"),
    ("body", "body", "string"),
    ("source", "source", "string"),
]


def typed(raw: DataFrame, fields: list[tuple[str, str, str]]) -> DataFrame:
    """The typed fields of VARIANT records; a value that does not convert becomes NULL.

    A record is converted once, to a struct, in which each field converts for itself. Times are read as
    the clock time as written: an offset neither moves them nor makes them depend on the session zone.
    """
    clock = "timestamp_ntz"
    kinds = ", ".join(f"`{src}`: {'string' if t == clock else t}" for _, src, t in fields)
    cut = raw.select(F.try_variant_get("record", "$", f"struct<{kinds}>").alias("_r"), "ingested_at")
    value = lambda src, t: F.col(f"_r.`{src}`").try_cast(t) if t == clock else F.col(f"_r.`{src}`")
    return cut.select(*[value(src, t).alias(out) for out, src, t in fields], "ingested_at")


def latest_version(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the newest row per key: by `order`, then by all remaining columns.

    A max over a struct combines map-side, so a key that was re-sent many times shrinks to one
    row per task before the shuffle. With strings among the columns it is a sort aggregate, so
    each side of the shuffle sorts the rows by key.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("_v")
    return df.groupBy(*keys).agg(newest).select(
        *[F.col(c) if c in keys else F.col(f"_v.{c}").alias(c) for c in df.columns]
    )


def silver_transactions(raw: DataFrame) -> DataFrame:
    """(record, ingested_at, ...) to one typed row per txn_id."""
    return latest_version(typed(raw, TRANSACTION_FIELDS), ["txn_id"], ["ingested_at", "txn_ts"]).drop(
        "ingested_at"
    )


def silver_news(raw: DataFrame) -> DataFrame:
    return latest_version(typed(raw, NEWS_FIELDS), ["news_id"], ["ingested_at", "published_at"]).drop(
        "ingested_at"
    )


def flatten_candles(raw: DataFrame) -> DataFrame:
    """Market payloads to one row per candle; candles without a close are dropped.

    The payload is converted once to a struct of parallel arrays, which are then zipped.
    The null test comes after the cast, so a JSON null counts as missing.
    """
    result = raw.select(
        F.try_variant_get("payload", "$.chart.result[0]", CHART_RESULT).alias("r"), "ingested_at"
    )
    quote = F.col("r.indicators.quote")[0]
    zipped = result.select(
        F.col("r.meta.symbol").alias("ticker"),
        F.inline(
            F.arrays_zip(
                F.col("r.timestamp").alias("epoch"),
                quote["open"].alias("open"),
                quote["high"].alias("high"),
                quote["low"].alias("low"),
                quote["close"].alias("close"),
                quote["volume"].alias("volume"),
            )
        ),
        "ingested_at",
    )
    return zipped.where(F.col("close").isNotNull() & F.col("epoch").isNotNull()).select(
        "ticker",
        epoch_to_ntz(F.col("epoch")).alias("ts"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        "ingested_at",
    )


def silver_market(raw: DataFrame, source: str | None = None) -> DataFrame:
    """Candles of all polls (or of one source), the newest version of each (ticker, ts).

    A daily backfill and the live feed may cover the same day, which then counts volume twice;
    `source` restricts the table to one of them.
    """
    if source is not None:
        raw = raw.where(F.col("source") == source)
    return latest_version(flatten_candles(raw), ["ticker", "ts"], ["ingested_at"])
