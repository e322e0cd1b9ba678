"""Newest-wins streaming deduplication: keyed state with event-time timers.

A re-sent record replaces an earlier one of the same key, whatever the order of arrival. The state
holds the newest version of each key of a time slot; a slot is dropped by a timer once the watermark
has passed its end, so the state follows the stream's reach and not its history. What leaves the
operator is every version that became the newest, marked as a correction if it replaced one.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ledgerlake.streaming.ingest import trigger_args

# The processor travels with its code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLOT_SECONDS = 600  # a slot is read and written whole, so it should hold few keys
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Newest(StatefulProcessor):
    """State per (grouping keys, time slot): the newest version of each key in the slot."""

    def __init__(self, columns: list[str], keys: list[str], order: list[str], state_schema: str, slot_seconds: int):
        self.columns, self.state_schema, self.slot_seconds = columns, state_schema, slot_seconds
        self.keys = [columns.index(k) for k in keys]
        # By the order columns, then by all others, so equal stamps do not depend on arrival.
        self.rank = [columns.index(c) for c in [*order, *[c for c in columns if c not in keys and c not in order]]]

    def init(self, handle) -> None:
        self.handle = handle
        self.slot = handle.getValueState("versions", self.state_schema)

    def _rank(self, row: tuple) -> tuple:
        return tuple((row[c] is not None, row[c] if row[c] is not None else 0) for c in self.rank)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = {}
        if self.slot.exists():
            held = {tuple(r[c] for c in self.keys): tuple(r) for r in self.slot.get()[0]}
        before, changed = set(held), {}
        for r in rows:
            row = tuple(r[c] for c in self.columns)
            own = tuple(row[c] for c in self.keys)
            if own not in held or self._rank(row) > self._rank(held[own]):
                held[own] = changed[own] = row
        if not changed:
            return
        self.slot.update((list(held.values()),))
        if not before:
            self.handle.registerTimer(int(key[-1] + 1) * self.slot_seconds * 1000)
        for own, row in changed.items():
            yield Row(*self.columns, "is_correction")(*row, own in before)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.slot.clear()
        return iter([])

    def close(self) -> None:
        pass


def stream_newest(
    df: DataFrame, keys: list[str], ts: str, order: list[str], watermark: str = "2 days", slot_seconds: int = SLOT_SECONDS,
    group: list[str] | None = None,
) -> DataFrame:
    """The rows of a stream that are the newest version of their key on arrival, with `is_correction`.

    keys contain the event time `ts`; order says which of two versions is newer. Rows behind the
    watermark do not pass, nor do rows without an event time, as their key is not known. A slot holds
    the keys of one value of `group`, by default of all keys but `ts`; a key that is new in nearly every row, as
    an id is, should not be among them.
    """
    columns = df.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    inside = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in df.schema.fields)
    processor = Newest(columns, keys, order, f"versions array<struct<{inside}>>", slot_seconds)
    timed = df.where(F.col(ts).isNotNull()).withColumn("event_time", F.col(ts).cast("timestamp")).withWatermark("event_time", watermark)
    timed = timed.withColumn("slot", F.floor(F.unix_seconds("event_time") / slot_seconds))
    by = [k for k in keys if k != ts] if group is None else group
    grouped = timed.groupBy(*by, "slot")
    return grouped.transformWithState(processor, f"{fields}, is_correction boolean", "Update", "EventTime")


def newest_to_table(
    df: DataFrame, keys: list[str], ts: str, order: list[str], path: str, checkpoint: str,
    watermark: str = "2 days", trigger: str | None = None, slot_seconds: int = SLOT_SECONDS, group: list[str] | None = None,
) -> StreamingQuery:
    """Write what stream_newest lets through, each batch to its own folder; a rerun replaces it."""
    spark = df.sparkSession
    out = stream_newest(df, keys, ts, order, watermark, slot_seconds, group)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    # Timers need this state store; a query keeps the setting that holds when it starts.
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        writer = out.writeStream.outputMode("update").foreachBatch(on_batch)
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger_args(trigger)).start()
    finally:
        spark.conf.set(PROVIDER, before)


def read_newest(spark: SparkSession, path: str, schema, keys: list[str]) -> DataFrame:
    """The table after all batches: per key the row of the last batch that changed it."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    rows = spark.read.schema(f"{fields}, is_correction boolean, batch_id long").parquet(path)
    last = rows.groupBy(*keys).agg(F.max("batch_id").alias("last"))
    same = [rows[k].eqNullSafe(last[k]) for k in keys]
    return rows.join(last, [*same, rows.batch_id == last["last"]], "left_semi").drop("is_correction", "batch_id")
