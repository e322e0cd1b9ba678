"""Daily marts of a stream by updates: state for open days only, late days from the stored rows.

Two queries read the same stream. One keeps daily aggregates in update mode; days behind the
watermark leave its state, and each batch replaces the days it changed in a table stored by day. The
other stores the typed rows by day. A row behind the watermark never reaches the first query, so the
second rebuilds its day from the stored rows, in a table of its own which readers prefer. No table
has two writers, and each batch is published in one step (sources/versioned.py).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.operators import gold
from ledgerlake.sources.versioned import Lake, folder
from ledgerlake.streaming.ingest import trigger_args
from ledgerlake.streaming.marts import with_event_time


@dataclass(frozen=True)
class Daily:
    """A daily mart: the time it is taken from, its keys beside the day, and both forms of it."""

    ts: str
    day: str
    keys: list[str]
    aggregates: Callable[[], list[Column]]
    batch: Callable[[DataFrame], DataFrame]
    schema: str

    @property
    def columns(self) -> list[str]:
        return [c.split()[0] for c in self.schema.split(", ")]

    @property
    def stored_schema(self) -> str:
        return f"{self.schema}, dt date"


SPEND = Daily(
    "txn_ts", "spend_date", [],
    lambda: [F.count("*").alias("txn_count"), F.sum("amount").alias("total_spend"), F.avg("amount").alias("avg_ticket")],
    gold.spend_daily,
    "spend_date date, txn_count long, total_spend double, avg_ticket double",
)
# Candles are keyed by (ticker, ts), as newest.stream_newest leaves them.
BARS = Daily(
    "ts", "trade_date", ["ticker"],
    lambda: [
        F.min_by("open", "event_time").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "event_time").alias("close"), F.sum("volume").alias("volume"),
    ],
    lambda rows: gold.ohlc_daily(rows, keyed=True),
    "ticker string, trade_date date, open double, high double, low double, close double, volume long",
)


def updates(rows: DataFrame, mart: Daily, watermark: str) -> DataFrame:
    """The mart as a stream; in update mode days behind the watermark leave the state."""
    timed = with_event_time(rows, mart.ts, watermark)
    day = F.window("event_time", "1 day")
    out = timed.groupBy(*mart.keys, day).agg(*mart.aggregates()).withColumn(mart.day, F.to_date("window.start"))
    return out.select(*mart.columns)


def _days(df: DataFrame) -> list:
    return [r.dt for r in df.select("dt").distinct().collect()]  # calendar days, so the list is short


def _replace(lake: Lake, table: str, mart: Daily, fresh: DataFrame, source: str, batch_id: int) -> None:
    """Replace the rows of the keys and days of a batch; only the touched days are read and written."""
    fresh = fresh.withColumn("dt", F.col(mart.day)).persist()
    try:
        days = [folder("dt", d) for d in _days(fresh)]
        rows = fresh
        if mart.keys:
            key = [*mart.keys, "dt"]
            rows = lake.read(table, mart.stored_schema, days).join(fresh.select(*key), key, "left_anti").unionByName(fresh)
        lake.publish({table: lake.stage(rows, table, "dt", uuid.uuid4().hex)}, source, batch_id)
    finally:
        fresh.unpersist()


def run_updates(
    rows: DataFrame, mart: Daily, root: str, checkpoint: str, watermark: str = "1 day", trigger: str | None = None
) -> StreamingQuery:
    """Keep the mart of open days up to date, in `root`/open."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        lake = Lake(batch.sparkSession, f"{root}/open")
        if not lake.done(checkpoint, batch_id):
            _replace(lake, "mart", mart, batch, checkpoint, batch_id)

    writer = updates(rows, mart, watermark).writeStream.outputMode("update").foreachBatch(on_batch)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger_args(trigger)).start()


def run_rows(
    rows: DataFrame, mart: Daily, root: str, checkpoint: str, watermark: str = "1 day", trigger: str | None = None
) -> StreamingQuery:
    """Store the rows by day, in `root`/rows, and rebuild days behind the watermark, in `root`/late.

    A day counts as late when it ends before the latest time seen so far less the delay. The files
    come in the same order to both queries, so this holds for every row the other query drops,
    whatever the batches of the two are; a day rebuilt without need is the same as the kept one.
    Rows without a time have no day in any mart and are stored only.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store, late = Lake(spark, f"{root}/rows"), Lake(spark, f"{root}/late")
        if not store.done(checkpoint, batch_id):
            version = f"{batch_id:09d}-{uuid.uuid4().hex}"
            staged = store.stage(batch.withColumn("dt", F.to_date(mart.ts)), "rows", "dt", version)
            times = store.staged("rows", f"{schema}, dt date", version)
            top = times.agg(F.unix_micros(F.max(mart.ts).cast("timestamp"))).first()[0]
            top = max(top or 0, store.state().numbers.get("top", 0))
            # Each batch's part of a day stays: partitions are named by day and version.
            store.publish({"rows": {f"{f}/{v}": v for f, v in staged.items()}}, checkpoint, batch_id, top=top)
        if late.done(checkpoint, batch_id):
            return
        top, parts = store.state().numbers["top"], store.state().tables.get("rows", {})
        mine = [p.split("/")[0] for p, v in parts.items() if int(v.split("-")[0]) == batch_id]
        ends = F.timestamp_micros(F.lit(top)) - F.expr(f"INTERVAL {watermark}")
        closed = spark.range(1).select(F.to_date(ends).alias("d")).first().d
        days = {f for f in mine if f != folder("dt", None) and f < folder("dt", closed)}
        if not days:
            late.publish({}, checkpoint, batch_id)
            return
        paths = [f"{root}/rows/rows/v={v}/{p.split('/')[0]}" for p, v in parts.items() if p.split("/")[0] in days]
        held = spark.read.schema(f"{schema}, dt date, v string").option("basePath", f"{root}/rows/rows").parquet(*paths)
        rebuilt = mart.batch(held.drop("dt", "v")).select(*mart.columns).withColumn("dt", F.col(mart.day))
        staged = late.stage(rebuilt, "mart", "dt", uuid.uuid4().hex)
        late.publish({"mart": staged}, checkpoint, batch_id)

    writer = rows.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger_args(trigger)).start()


def read_daily(spark: SparkSession, root: str, mart: Daily) -> DataFrame:
    """The mart over all days: rebuilt days in place of what the update query had for them."""
    late = Lake(spark, f"{root}/late")
    rebuilt = late.state().tables.get("mart", {})
    lake = Lake(spark, f"{root}/open")
    kept = [f for f in lake.state().tables.get("mart", {}) if f not in rebuilt]
    out = lake.read("mart", mart.stored_schema, kept).unionByName(late.read("mart", mart.stored_schema))
    return out.select(*mart.columns)
