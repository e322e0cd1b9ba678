"""Streaming deduplication and daily marts, and the chained refresh per micro-batch."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.operators import gold, search, segments, silver
from ledgerlake.session import CODEC
from ledgerlake.sources.adapters import is_folder
from ledgerlake.sources.versioned import Lake, folder
from ledgerlake.streaming import ingest
from ledgerlake.streaming.ingest import read_stream, trigger_args


def with_event_time(df: DataFrame, col: str, delay: str) -> DataFrame:
    """Watermarks need a zoned timestamp; the column is NTZ in UTC."""
    return df.withColumn("event_time", F.col(col).cast("timestamp")).withWatermark("event_time", delay)


def stream_dedup(df: DataFrame, keys: list[str], ts: str, watermark: str = "1 day") -> DataFrame:
    """First version of each key within the stream's state; a re-send within the watermark is dropped.

    Records older than the watermark do not pass; dedup_to_table() keeps those too.
    """
    return with_event_time(df, ts, watermark).dropDuplicatesWithinWatermark(keys).drop("event_time")


def dedup_to_table(
    df: DataFrame, keys: list[str], ts: str, path: str, checkpoint: str, trigger: str | None = None, days: int = 1
) -> StreamingQuery:
    """First version of each key as a table by batch and day, whenever it arrives.

    A record is compared with what is stored up to `days` days around its own day, so a re-send is
    dropped and a late record that was never seen is kept, however far behind the stream it is.
    Only those days are read. Each batch writes its own folder, so a rerun replaces its rows.
    A record without a time comes after those with one and is compared with all stored days, which
    are read only if a batch has such records. Records with a null in their key all stay.
    """
    schema = df.schema
    sortable = [f.name for f in schema.fields if f.name not in (*keys, ts) and not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        day = F.to_date(ts)
        keyed = F.lit(True)
        for k in keys:
            keyed = keyed & F.col(k).isNotNull()
        order = F.struct(F.col(ts).isNull().alias("no_time"), F.col(ts), *sortable)  # never null itself
        first = batch.where(keyed).groupBy(*keys).agg(F.min_by(F.struct(*[c for c in batch.columns if c not in keys]), order).alias("v"))
        first = first.select(*keys, "v.*").select(*batch.columns).unionByName(batch.where(~keyed)).withColumn("dt", day)
        if batch_id and is_folder(spark, path):
            span = first.agg(F.date_sub(F.min("dt"), days).alias("a"), F.date_add(F.max("dt"), days).alias("b"), F.max(F.col("dt").isNull() & keyed).alias("undated")).first()
            stored = read_deduped(spark, path, schema).where(F.col("batch_id") != batch_id)
            near = stored.where(F.col("dt").between(span.a, span.b) | F.col("dt").isNull()) if span.a else stored.where("dt is null")
            first = first.join(near.select(*keys).distinct(), keys, "left_anti")
            if span.undated:
                rest = first.where("dt is null").join(stored.select(*keys).distinct(), keys, "left_anti")
                first = first.where("dt is not null").unionByName(rest)
        first.write.mode("overwrite").partitionBy("dt").parquet(f"{path}/batch_id={batch_id}")

    return (
        df.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_args(trigger))
        .start()
    )


def read_deduped(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of dedup_to_table with batch_id and dt; schema: that of the stream."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return spark.read.schema(f"{fields}, batch_id long, dt date").parquet(path)


def stream_spend_daily(txn: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Daily spend over one-day windows; in update or append mode days before the watermark leave the state."""
    day = F.window("event_time", "1 day")
    return (
        with_event_time(txn, "txn_ts", watermark)
        .groupBy(day)
        .agg(
            F.count("*").alias("txn_count"),
            F.sum("amount").alias("total_spend"),
            F.avg("amount").alias("avg_ticket"),
        )
        .select(F.to_date("window.start").alias("spend_date"), "txn_count", "total_spend", "avg_ticket")
    )


def stream_ohlc_daily(prices: DataFrame, watermark: str = "1 day") -> DataFrame:
    return (
        with_event_time(prices, "ts", watermark)
        .groupBy("ticker", F.window("event_time", "1 day"))
        .agg(
            F.min_by("open", F.struct("ts", "open")).alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", F.struct("ts", "close")).alias("close"),
            F.sum("volume").alias("volume"),
        )
        .select("ticker", F.to_date("window.start").alias("trade_date"), "open", "high", "low", "close", "volume")
    )


def write_table(
    df: DataFrame, path: str, checkpoint: str, mode: str = "append", trigger: str | None = None
) -> StreamingQuery:
    """Write a stream to parquet: append adds files, complete replaces the table every batch."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(**trigger_args(trigger))
    if mode == "append":
        return writer.format("parquet").option("path", path).start()
    return writer.foreachBatch(lambda b, _: b.write.mode("overwrite").parquet(path)).start()


@dataclass(frozen=True)
class Lane:
    """How raw records of one kind become a typed table and which daily marts follow from it."""

    keys: list[str]
    ts: str
    schema: str
    parse: Callable[[DataFrame], DataFrame]
    marts: Callable[[DataFrame], dict[str, tuple[DataFrame, str]]]
    sums: Callable[[DataFrame], DataFrame] | None = None
    mapped: tuple[str, ...] = ()  # marts with a row per row of silver

    @property
    def typed_schema(self) -> str:
        return f"{self.schema}, ingested_at timestamp_ntz"

    @property
    def silver_schema(self) -> str:
        return f"{self.typed_schema}, dt date"

    @property
    def order(self) -> list[str]:
        return ["ingested_at"] if self.ts in self.keys else ["ingested_at", self.ts]

    @property
    def moves(self) -> bool:
        """Whether a newer version of a record may have another day."""
        return self.ts not in self.keys

    @property
    def index_schema(self) -> str:
        types = dict(column.split(" ", 1) for column in self.schema.split(", "))
        return ", ".join(f"{k} {types[k]}" for k in self.keys) + ", dt date, bucket int"


def _ddl(fields: list[tuple[str, str, str]]) -> str:
    return ", ".join(f"{out} {t}" for out, _, t in fields)


def _spend_marts(now: DataFrame) -> dict[str, tuple[DataFrame, str]]:
    totals = [F.count("*").alias("txn_count"), F.sum("amount").alias("total_spend")]
    day = F.col("dt").alias("spend_date")
    return {
        "spend_by_category": (now.groupBy(day, "category").agg(*totals), "spend_date"),
        "spend_daily": (now.groupBy(day).agg(*totals, F.avg("amount").alias("avg_ticket")), "spend_date"),
    }


def _market_marts(now: DataFrame) -> dict[str, tuple[DataFrame, str]]:
    return {"ohlc_daily": (gold.ohlc_daily(now, keyed=True), "trade_date")}


TRANSACTIONS = Lane(
    ["txn_id"], "txn_ts", _ddl(silver.TRANSACTION_FIELDS),
    lambda raw: silver.typed(raw, silver.TRANSACTION_FIELDS), _spend_marts, gold.account_sums,
)
MARKET = Lane(
    ["ticker", "ts"], "ts",
    "ticker string, ts timestamp_ntz, open double, high double, low double, close double, volume long",
    lambda raw: silver.flatten_candles(raw.withColumnRenamed("record", "payload")), _market_marts,
)
NEWS = Lane(
    ["news_id"], "published_at", _ddl(silver.NEWS_FIELDS),
    lambda raw: silver.typed(raw, silver.NEWS_FIELDS),
    lambda now: {"news": (gold.gold_news(now), "dt")}, mapped=("news",),
)


def read_silver(spark: SparkSession, root: str, lane: Lane = TRANSACTIONS) -> DataFrame:
    return Lake(spark, root).read("silver", lane.silver_schema)


def read_spend_daily(spark: SparkSession, root: str) -> DataFrame:
    return Lake(spark, root).read("spend_daily", "txn_count long, total_spend double, avg_ticket double, spend_date date")


def read_spend_by_category(spark: SparkSession, root: str) -> DataFrame:
    return Lake(spark, root).read("spend_by_category", "category string, txn_count long, total_spend double, spend_date date")


def read_market_daily(spark: SparkSession, root: str) -> DataFrame:
    """Daily bars with returns; the return spans days, so it is taken over the whole mart."""
    schema = "ticker string, open double, high double, low double, close double, volume long, trade_date date"
    return gold.daily_return(Lake(spark, root).read("ohlc_daily", schema))


def read_news(spark: SparkSession, root: str) -> DataFrame:
    return Lake(spark, root).read("news", NEWS.silver_schema).drop("dt")


def read_account_means(spark: SparkSession, root: str) -> DataFrame:
    """The account means as the kept sums give them; no transaction is read."""
    return gold.means_of(Lake(spark, root).read("account_sums", SUMS_SCHEMA).drop("bucket"))


def read_txn_features(spark: SparkSession, root: str) -> DataFrame:
    """Features of all live transactions, with the means that the refresh keeps."""
    return gold.txn_features(read_silver(spark, root).drop("ingested_at", "dt"), read_account_means(spark, root))


SUMS_SCHEMA = "account_id string, category string, rows long, n long, s decimal(38,2), bucket int"
ACCOUNT_BUCKETS = 64
FIRST_BUCKETS = 16
KEYS_PER_BUCKET = 1 << 19
BROADCAST_KEYS = 200_000
VERSIONS = 4  # of a day or bucket, before it is rewritten as one


def refresh(
    batch: DataFrame, root: str, lane: Lane = TRANSACTIONS, source: str = "", batch_id: int | None = None, stored: bool = False
) -> None:
    """Fold new typed records into silver and rebuild the marts of the touched days only.

    Silver and marts are stored by day. Which day holds the older version of a record is looked up
    in an index of (key, day), stored by key hash: only the buckets of the batch's keys are read,
    and buckets are split as they fill, so the cost of a batch does not grow with the history.
    Days that hold an older version are rewritten, to others the new records are added as further files.
    Account sums take the old images of changed rows off and add the new ones.

    Everything is written beside the live tables and published in one step; a batch that fails
    before changes nothing, one that is replayed after it is skipped. A batch that is `stored`, as
    files that can be read again, is not kept in memory.
    """
    spark, lake = batch.sparkSession, Lake(batch.sparkSession, root)
    if lake.done(source, batch_id):
        return
    version = uuid.uuid4().hex
    batch = batch if stored else batch.persist()
    try:
        with _newest(batch, lane) as fresh:
            _fold(lake, lane, fresh.withColumn("dt", F.to_date(lane.ts)), version, source, batch_id)
    finally:
        batch.unpersist()


@contextmanager
def _kept(df: DataFrame) -> Iterator[DataFrame]:
    df = df.persist()
    try:
        yield df
    finally:
        df.unpersist()


@contextmanager
def _newest(batch: DataFrame, lane: Lane) -> Iterator[DataFrame]:
    """The newest version of each record in a batch; only those sent more than once are shuffled while they are few."""
    with _kept(batch.groupBy(*lane.keys).count().where("count > 1")) as resent:
        n = resent.count()
        if not n:
            yield batch
        elif n <= BROADCAST_KEYS:
            newest = silver.latest_version(_of(batch, resent, lane.keys, few=True), lane.keys, lane.order)
            yield _of(batch, resent, lane.keys, "left_anti", few=True).unionByName(newest)
        else:
            with _kept(silver.latest_version(batch, lane.keys, lane.order)) as newest:
                yield newest


def _bucket(columns: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int").alias("bucket")


def _values(df: DataFrame, column: str) -> list:
    """The distinct values of a column that has few: calendar days or bucket numbers."""
    return [r[0] for r in df.select(column).distinct().collect()]


def _of(rows: DataFrame, keyed: DataFrame, keys: list[str], how: str = "left_semi", few: bool = False) -> DataFrame:
    """The rows whose keys occur in another frame (or do not); a null equals a null. `few` keys are broadcast."""
    other = keyed.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return rows.join(F.broadcast(other) if few else other, same, how)


def _changed(lake: Lake, table: str, staged: dict[str, str], rewritten: set[str]) -> dict[str, str | None]:
    """Staged partitions take the place of the rewritten ones and stand beside the others."""
    gone = {name: None for name in lake.state().tables.get(table, {}) if name.split("@")[0] in rewritten}
    return {**gone, **{f"{f}@{v}": v for f, v in staged.items()}}


def _crowded(lake: Lake, table: str, folders: list[str]) -> set[str]:
    """The partitions that live in VERSIONS versions already and are due to become one."""
    n = Counter(name.split("@")[0] for name in lake.state().tables.get(table, {}))
    return {f for f in folders if n[f] >= VERSIONS}


def _replaced(staged: dict[str, str], asked: list[str]) -> dict[str, str | None]:
    """The staged partitions, and None for those that were asked for and are empty now."""
    return {**dict.fromkeys(asked), **staged}


def _fold(lake: Lake, lane: Lane, fresh: DataFrame, version: str, source: str, batch_id: int | None) -> None:
    if not lane.moves:
        _fold_days(lake, lane, fresh, version, source, batch_id)
        return
    n = lake.state().numbers.get("buckets", FIRST_BUCKETS)
    # Calendar days and bucket numbers, so both are short lists.
    touched = fresh.agg(F.collect_set(F.struct("dt")).alias("days"), F.collect_set(_bucket(lane.keys, n)).alias("buckets")).first()
    days, buckets = [r.dt for r in touched.days], [folder("bucket", b) for b in touched.buckets]
    known = lake.read("keys", lane.index_schema, buckets).drop("bucket")
    with _kept(_of(known, fresh, lane.keys)) as hits:
        _fold_known(lake, lane, fresh, known, hits, days, buckets, n, version, source, batch_id)
    _grow_index(lake, lane, buckets, version, n)


def _fold_known(
    lake: Lake, lane: Lane, fresh: DataFrame, known: DataFrame, hits: DataFrame, days: list, buckets: list[str], n: int,
    version: str, source: str, batch_id: int | None,
) -> None:
    """known: the index entries in the batch's buckets; hits: those of them whose records come again."""
    changes: dict[str, dict[str, str | None]] = {}
    keys, again = lane.keys, hits.count()
    few = again <= BROADCAST_KEYS
    moved = _values(hits, "dt") if again else []
    days = list({*days, *moved})
    rewritten = {folder("dt", d) for d in moved} | _crowded(lake, "silver", [folder("dt", d) for d in days])
    held = lake.read("silver", lane.silver_schema, list(rewritten))
    if not again:
        merged = held.unionByName(fresh)
    elif few:
        won = silver.latest_version(_of(held, hits, keys, few=True).unionByName(_of(fresh, hits, keys, few=True)), keys, lane.order)
        apart = [_of(rows, hits, keys, "left_anti", few=True) for rows in (held, fresh)]
        merged = apart[0].unionByName(apart[1]).unionByName(won)
    else:  # a key has two rows at most, so nothing is gained by combining them before the shuffle
        merged = silver.latest_version(held.unionByName(fresh).repartition(*keys), keys, lane.order)
    staged = lake.stage(merged, "silver", "dt", version)
    changes["silver"] = _changed(lake, "silver", staged, rewritten)
    written = lake.staged("silver", lane.silver_schema, version)
    now = written.unionByName(lake.read("silver", lane.silver_schema, [f for d in days if (f := folder("dt", d)) not in rewritten]))
    _stage_marts(lake, lane, now, days, version, changes)

    after = _of(written, fresh, keys) if again else fresh
    index, whole = after.select(*keys, "dt"), set(buckets) if again else _crowded(lake, "keys", buckets)
    if again:
        index = index.unionByName(_of(known, hits, keys, "left_anti", few=few))
    elif whole:
        index = index.unionByName(lake.read("keys", lane.index_schema, list(whole)).drop("bucket"))
    changes["keys"] = _changed(lake, "keys", lake.stage(index.withColumn("bucket", _bucket(keys, n)), "keys", "bucket", version), whole)
    if lane.sums:
        before = _of(held, hits, keys, few=few) if again else None
        _stage_sums(lake, lane, before, after, version, changes)
    lake.publish(changes, source, batch_id)


def _fold_days(lake: Lake, lane: Lane, fresh: DataFrame, version: str, source: str, batch_id: int | None) -> None:
    """Records whose versions all have one day: that day holds the older ones."""
    days = _values(fresh, "dt")
    in_days = [folder("dt", d) for d in days]
    held = lake.read("silver", lane.silver_schema, in_days)
    merged = silver.latest_version(held.unionByName(fresh), lane.keys, lane.order)
    changes = {"silver": _replaced(lake.stage(merged, "silver", "dt", version), in_days)}
    _stage_marts(lake, lane, lake.staged("silver", lane.silver_schema, version), days, version, changes)
    lake.publish(changes, source, batch_id)


def _stage_marts(lake: Lake, lane: Lane, now: DataFrame, days: list, version: str, changes: dict) -> None:
    for name, (mart, day) in lane.marts(now).items():
        # A mart that only maps silver's rows is written as they lie, by day.
        staged = lake.stage(mart, name, day, version, dealt=name in lane.mapped)
        changes[name] = _replaced(staged, [folder(day, d) for d in days])


def _stage_sums(lake: Lake, lane: Lane, before: DataFrame | None, after: DataFrame, version: str, changes: dict) -> None:
    """Account sums with the old images taken off and the new ones added; the touched buckets only."""
    delta = lane.sums(after)
    if before is not None:
        less = lane.sums(before).select("account_id", "category", *[(-F.col(c)).alias(c) for c in ("rows", "n", "s")])
        delta = less.unionByName(delta)
    delta = delta.withColumn("bucket", _bucket(["account_id"], ACCOUNT_BUCKETS)).persist()
    try:
        buckets = [folder("bucket", b) for b in _values(delta, "bucket")]
        kept = lake.read("account_sums", SUMS_SCHEMA, buckets)
        total = kept.unionByName(delta).groupBy("account_id", "category", "bucket").agg(
            F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.coalesce(F.sum("s"), F.lit(0)).cast("decimal(38,2)").alias("s")
        )
        changes["account_sums"] = _replaced(lake.stage(total.where("rows > 0"), "account_sums", "bucket", version), buckets)
    finally:
        delta.unpersist()


def _grow_index(lake: Lake, lane: Lane, buckets: list[str], version: str, n: int) -> None:
    """Four times the buckets once those just written to hold more than KEYS_PER_BUCKET keys on average.

    The index is rewritten then; as it has grown four-fold since the last time, that is a bounded
    share of the work per record.
    """
    if lake.read("keys", lane.index_schema, buckets).count() <= KEYS_PER_BUCKET * max(len(buckets), 1):
        return
    index = lake.read("keys", lane.index_schema).drop("bucket").withColumn("bucket", _bucket(lane.keys, 4 * n))
    staged = lake.stage(index, "keys", "bucket", f"{version}-{4 * n}")
    lake.publish({"keys": _replaced(staged, list(lake.state().tables["keys"]))}, buckets=4 * n)


def forget_days(spark: SparkSession, root: str, days: list, lane: Lane = TRANSACTIONS) -> None:
    """Delete whole days from silver, marts, index and account sums, in one step."""
    lake, version = Lake(spark, root), uuid.uuid4().hex
    in_days = [folder("dt", d) for d in days]
    gone = lake.read("silver", lane.silver_schema, in_days)
    changes: dict[str, dict[str, str | None]] = {"silver": _changed(lake, "silver", {}, set(in_days))}
    none = gone.where("false")
    for name, (_, day) in lane.marts(none).items():
        changes[name] = dict.fromkeys(folder(day, d) for d in days)
    if lane.moves:
        n = lake.state().numbers.get("buckets", FIRST_BUCKETS)
        buckets = [folder("bucket", b) for b in _values(gone.select(_bucket(lane.keys, n)), "bucket")]
        index = _of(lake.read("keys", lane.index_schema, buckets), gone, lane.keys, "left_anti")
        changes["keys"] = _changed(lake, "keys", lake.stage(index, "keys", "bucket", version), set(buckets))
    if lane.sums:
        _stage_sums(lake, lane, gone, none, version, changes)
    lake.publish(changes)


def run_medallion(
    spark: SparkSession,
    path: str,
    root: str,
    checkpoint: str,
    lane: Lane = TRANSACTIONS,
    trigger: str | None = None,
    files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Files to silver to marts after every arrival; the checkpoint's path names the source in the manifest."""

    def on_batch(text: DataFrame, batch_id: int) -> None:
        # Raw records and malformed lines are kept, so a batch can be looked at and replayed.
        ingest.land(text, f"{root}/raw", batch_id)
        raw = ingest.read_bronze(spark, f"{root}/raw", batch_id).drop("batch_id")
        # Parsed once and written; the refresh reads columns and has no lineage to the text.
        arrived = f"{root}/arrived/batch_id={batch_id}"
        lane.parse(raw).write.mode("overwrite").option("compression", CODEC).parquet(arrived)
        refresh(spark.read.schema(lane.typed_schema).parquet(arrived), root, lane, checkpoint, batch_id, stored=True)

    return (
        read_stream(spark, path, files_per_trigger)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_args(trigger))
        .start()
    )


def refresh_index(
    spark: SparkSession, news: DataFrame, root: str, checkpoint: str, trigger: str | None = None
) -> StreamingQuery:
    """Append the postings and attributes of new articles; `trigger="1 hour"` bounds the lag.

    A re-sent or corrected article is indexed anew in its batch; readers leave out its older postings.

    Corpus statistics are not stored: scoring derives them from the tables it reads.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        latest = silver.latest_version(batch, ["news_id"], ["published_at"])
        search.write_index(search.build_index(latest), root, f"batch_id={batch_id}")

    return (
        news.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_args(trigger))
        .start()
    )


def refresh_segments(
    spark: SparkSession, news: DataFrame, root: str, checkpoint: str, trigger: str | None = None
) -> StreamingQuery:
    """Add each batch of articles to a stored segment index (operators/segments.py); a replay changes nothing."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        segments.refresh(batch.sparkSession, batch, root, source=checkpoint, batch_id=batch_id)

    return (
        news.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_args(trigger))
        .start()
    )
