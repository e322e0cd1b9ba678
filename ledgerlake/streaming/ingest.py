"""Incremental file ingest: each landed file is loaded once, tracked by the checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.session import CODEC
from ledgerlake.sources import bronze

# One JSON value per line keeps files splittable; a batch may be an array or a single object.
TEXT_SCHEMA = "value string"


def read_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(TEXT_SCHEMA).option("recursiveFileLookup", "true")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return bronze.with_source_file(reader.text(path))


def trigger_args(trigger: str | None) -> dict:
    """None runs once over what is there; an interval such as "15 seconds" keeps watching."""
    return {"availableNow": True} if trigger is None else {"processingTime": trigger}


def land(batch: DataFrame, table: str, batch_id: int) -> None:
    """Write a batch's records to `table` and its malformed lines to `<table>_bad`; a rerun replaces both."""
    # Records are stored as VARIANT, so that their text is neither made from it nor parsed a second time.
    bronze.records(bronze.with_parsed(batch)).write.mode("overwrite").option("compression", CODEC).parquet(f"{table}/batch_id={batch_id}")
    bad = bronze.split_bad(batch)[1]
    bad.write.mode("overwrite").option("compression", CODEC).parquet(f"{table}_bad/batch_id={batch_id}")


def stream_bronze(
    spark: SparkSession,
    path: str,
    table: str,
    checkpoint: str,
    trigger: str | None = None,
    files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Append the records of new files to a bronze parquet folder, bad lines to `<table>_bad`.

    Each batch writes its own `batch_id` folder with overwrite, so a batch that is replayed after
    a failure replaces its earlier output instead of doubling it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        land(batch, table, batch_id)

    return (
        read_stream(spark, path, files_per_trigger)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_args(trigger))
        .start()
    )


def read_bad(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.schema("text string, src_file string, batch_id long").parquet(f"{table}_bad")


def read_bronze(spark: SparkSession, table: str, batch_id: int | None = None) -> DataFrame:
    """Landed records, of one batch if it is given (only its folder is read)."""
    raw = spark.read.schema("record variant, src_file string, ingested_at timestamp_ntz, batch_id long").parquet(table)
    return raw if batch_id is None else raw.where(F.col("batch_id") == batch_id)
