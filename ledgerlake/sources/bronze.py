"""Raw landing: JSON files and market payloads to VARIANT rows with lineage columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Batches are written as one JSON value per line ("lines", splittable) or as one value that may
# span lines ("file", one file per task).
LAYOUTS = ("lines", "file")


def read_json_text(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """(text, src_file) of every JSON value under a path."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    raw = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=layout == "file")
    return with_source_file(raw)


def with_source_file(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("value").alias("text"), F.col("_metadata.file_path").alias("src_file")).where(
        F.col("text").rlike(r"\S")
    )


def with_parsed(text: DataFrame) -> DataFrame:
    return text.withColumn("parsed", F.try_parse_json("text"))


def split_bad(text: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good with a `parsed` VARIANT, quarantine with the raw text) — bad input never stops a load."""
    parsed = with_parsed(text)
    good = parsed.where(F.col("parsed").isNotNull()).drop("text")
    return good, parsed.where(F.col("parsed").isNull()).drop("parsed")


def read_with_schema(spark: SparkSession, path: str, fields: list[tuple[str, str, str]]) -> DataFrame:
    """JSON values read by a given schema: the fields as text, `_corrupt_record` for what is no JSON record.

    Every field is read as text, so a value of another type is kept for the typed cast to judge.
    """
    schema = ", ".join([*(f"`{src}` string" for _, src, _ in fields), "_corrupt_record string"])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
    raw = reader.option("recursiveFileLookup", "true").json(path)
    return raw.select("*", F.col("_metadata.file_path").alias("src_file"))


def split_typed(raw: DataFrame, fields: list[tuple[str, str, str]]) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejects) of read_with_schema().

    A reject is one field whose value does not convert: its record's first field, the field's name,
    the value and the file; the typed row keeps null there. A value that is no record at all is
    rejected as `_corrupt_record` and gives no row.
    """
    no_record = F.coalesce(*[F.col(src) for _, src, _ in fields]).isNull() & F.col("_corrupt_record").isNotNull()
    typed = [F.col(src).try_cast(t) for _, src, t in fields]
    good = raw.where(~no_record).select(*[c.alias(out) for c, (out, _, _) in zip(typed, fields)], "src_file")
    key = fields[0][1]
    failed = F.array(*[
        F.when(F.col(src).isNotNull() & c.isNull(), F.struct(F.lit(out).alias("field"), F.col(src).alias("value")))
        for c, (out, src, _) in zip(typed, fields)
    ])
    whole = F.array(F.struct(F.lit("_corrupt_record").alias("field"), F.col("_corrupt_record").alias("value")))
    rejects = raw.select(
        F.when(~no_record, F.col(key)).alias("record_key"),
        F.explode(F.when(no_record, whole).otherwise(F.filter(failed, lambda f: f.isNotNull()))).alias("r"), "src_file",
    )
    return good, rejects.select("record_key", "r.field", "r.value", "src_file")


def records(good: DataFrame) -> DataFrame:
    """(record, src_file, ingested_at): the outer array is stripped, a lone object is one record."""
    # Anything but an array does not convert and is passed through as one record.
    items = F.coalesce(F.try_variant_get("parsed", "$", "array<variant>"), F.array("parsed"))
    # No item comes of a line that does not parse, so `good` needs no filter, which would parse each line again.
    items = F.when(F.col("parsed").isNotNull(), items)
    return good.select(F.explode(items).alias("record"), "src_file").withColumn(
        "ingested_at", now_ntz()
    )


def read_json_records(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    return records(with_parsed(read_json_text(spark, path, layout)))


def now_ntz() -> Column:
    return F.current_timestamp().cast("timestamp_ntz")


def land_market(payloads: DataFrame, source: str = "yahoo") -> DataFrame:
    """(ticker, payload_text[, ingested_at]) to raw market rows; empty or unparsable text is skipped."""
    stamp = F.col("ingested_at") if "ingested_at" in payloads.columns else now_ntz()
    # As an element the payload is made once: a filter on it moves no further down and parses no text again.
    payload = F.when(F.length("payload_text") > 0, F.try_parse_json("payload_text"))
    return (
        payloads.select("ticker", F.explode(F.array(payload)).alias("payload"), stamp.alias("ingested_at"))
        .where(F.col("payload").isNotNull())
        .select("ticker", "payload", F.lit(source).alias("source"), "ingested_at")
    )


def pack_chart(bars: DataFrame) -> DataFrame:
    """Candles to one chart payload per ticker and day.

    A payload covers one day, as a poll does, so an array holds at most one candle per second
    of a day however long the ticker's history is.
    """
    candle = F.struct(F.unix_seconds(F.col("ts").cast("timestamp")).alias("epoch"),
                      "open", "high", "low", "close", "volume")
    day = bars.groupBy("ticker", F.to_date("ts").alias("trade_date")).agg(
        F.sort_array(F.collect_list(candle)).alias("c")  # array_sort calls a function for every comparison
    )

    def column(name: str) -> Column:
        return F.col(f"c.{name}").alias(name)

    quote = F.struct(*[column(n) for n in ("open", "high", "low", "close", "volume")])
    payload = F.struct(
        F.struct(
            F.array(
                F.struct(
                    F.struct(F.col("ticker").alias("symbol")).alias("meta"),
                    F.col("c.epoch").alias("timestamp"),
                    F.struct(F.array(quote).alias("quote")).alias("indicators"),
                )
            ).alias("result")
        ).alias("chart")
    )
    return day.select(
        "ticker", "trade_date", F.to_json(payload, {"ignoreNullFields": "false"}).alias("payload_text")
    )


def transaction_json(txn: DataFrame) -> Column:
    """JSON text of one raw transaction record."""
    return F.to_json(
        F.struct(
            "txn_id", "account_id",
            F.date_format("txn_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"),
            "amount", "category", "merchant", "city", "country", "channel",
            F.col("is_fraud_label").alias("is_fraud"),
        )
    )


def news_json(news: DataFrame) -> Column:
    return F.to_json(
        F.struct(
            "news_id",
            F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"),
            "ticker", "headline", "body", "source",
        )
    )


def values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Inline relation."""
    return spark.createDataFrame(rows, schema)


def date_spine(span: DataFrame, start: str = "d0", end: str = "d1") -> DataFrame:
    """Every date from `start` to `end` of a one-row frame."""
    return span.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("d"))
