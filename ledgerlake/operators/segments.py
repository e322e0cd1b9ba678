"""A stored search index of segments, with upper bounds that let a search skip blocks of articles.

Articles of a ticker and of like length make a block of about BLOCK_DOCS. Postings are stored as one
row per (term, block): the articles with their term counts, and in columns of their own the largest
count, the smallest length and the number of articles. From these follow, for any corpus
statistics, an upper bound of the term's share of a score in that block, and the term's document
frequency, without the articles being read.

A search sums the bounds per (query, block), scores the FIRST_BLOCKS best blocks of each query, and
then only those other blocks whose bound reaches the query's k-th score. What is skipped cannot be
among the first k, so the result is that of scoring every article.

Each refresh adds a segment and lists the older versions of its articles as dead, with their terms, so
document frequencies, number and mean length stay exact. Segments of like size are merged, FAN at a
time, so a search reads a number of segments that grows with the logarithm of the refreshes. All of
it is published in one step (sources/versioned.py).
"""

from __future__ import annotations

import math
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.functions.tokens import tokens
from ledgerlake.operators.search import B, K1, bucket_of, query_terms
from ledgerlake.operators.silver import latest_version
from ledgerlake.operators.skew import fits
from ledgerlake.session import scratch_dir
from ledgerlake.sources.versioned import Lake, folder

# The batch function travels with its code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_DOCS = 256
BLOCK_WORDS = 1 << 21  # a task holds the words of one block
ID_BUCKETS = 16
FIRST_BLOCKS = 8
FAN = 4
BROADCAST_TERMS = 200_000
ENTRIES = (
    "seg string, block long, ticker string, term string, n long, max_tf int, min_dl int, "
    "ids array<string>, tfs array<int>, dls array<int>"
)
POSTINGS = f"{ENTRIES}, bucket int"
DEAD = "news_id string, seg string"
DEAD_TERMS = "term string, n long, seg string"


def _documents(news: DataFrame, text_col: str, seg: str) -> DataFrame:
    """The articles with their length, block and id bucket.

    They are written to scratch with their length first: the blocks need the sizes of all bands, and the
    words are counted once for both.
    """
    spark, path = news.sparkSession, scratch_dir(news.sparkSession, "articles")
    cut = news.withColumn("dl", F.coalesce(F.size(tokens(F.col(text_col))), F.lit(0)))
    cut.withColumn("band", F.floor(F.log1p(F.col("dl").cast("double")) * 4).cast("int")).write.parquet(path)
    cut = spark.read.parquet(path)
    sizes = cut.groupBy(F.col("ticker").alias("s_ticker"), F.col("band").alias("s_band")).agg(
        F.count("*").alias("held"), F.sum("dl").alias("words")
    )
    same = F.col("ticker").eqNullSafe(F.col("s_ticker")) & (F.col("band") == F.col("s_band"))
    parts = F.greatest(F.ceil(F.col("held") / BLOCK_DOCS), F.ceil(F.col("words") / BLOCK_WORDS))
    part = F.pmod(F.xxhash64("news_id"), parts)
    block = F.xxhash64("ticker", "band", part)
    return cut.join(sizes, same).withColumns(
        {"block": block, "seg": F.lit(seg), "bucket": F.pmod(F.xxhash64("news_id", F.lit(1)), F.lit(ID_BUCKETS)).cast("int")}
    ).drop("band", "held", "words", "s_ticker", "s_band")


def _postings_of(parts: list[pa.RecordBatch]) -> pa.RecordBatch | None:
    """A row per term of one block: its articles by position, their term counts and lengths."""
    block = pa.Table.from_batches(parts).combine_chunks()
    words = block["words"].combine_chunks()
    size = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    coded = words.flatten().dictionary_encode()
    if not len(coded):
        return None
    pair = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(size) + np.repeat(np.arange(len(size)), size)
    pair, tf = np.unique(pair, return_counts=True)
    term, doc = pair // len(size), pair % len(size)
    first = np.flatnonzero(np.diff(term, prepend=-1))
    offsets = pa.array(np.append(first, len(term)).astype(np.int32))
    dl = block["dl"].to_numpy()[doc]
    ids = block["news_id"].combine_chunks().take(pa.array(doc))
    same = pa.array(np.zeros(len(first), dtype=np.int32))
    return pa.RecordBatch.from_arrays(
        [
            *(block[c].combine_chunks().take(same) for c in ("seg", "block", "ticker")),
            coded.dictionary.take(pa.array(term[first])), pa.array(np.diff(np.append(first, len(term)))),
            pa.array(np.maximum.reduceat(tf, first).astype(np.int32)), pa.array(np.minimum.reduceat(dl, first).astype(np.int32)),
            pa.ListArray.from_arrays(offsets, ids), pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int32))),
            pa.ListArray.from_arrays(offsets, pa.array(dl.astype(np.int32))),
        ],
        names=["seg", "block", "ticker", "term", "n", "max_tf", "min_dl", "ids", "tfs", "dls"],
    )


def _postings(docs: DataFrame, text_col: str) -> DataFrame:
    """A row per (block, term). Articles are shuffled by block, not by word: a task counts a block at a time."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        at = None
        for batch in batches:
            block = batch.column(1).to_numpy()
            cuts = np.flatnonzero(block[1:] != block[:-1]) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a == b:
                    continue
                if held and block[a] != at:
                    if found := _postings_of(held):
                        yield found
                    held = []
                at = block[a]
                held.append(batch.slice(a, b - a))
        if held and (found := _postings_of(held)):
            yield found

    dealt = docs.select("seg", "block", "ticker", "news_id", "dl", text_col).repartition("block").sortWithinPartitions("block")
    words = dealt.select("seg", "block", "ticker", "news_id", "dl", tokens(F.col(text_col)).alias("words"))
    return words.mapInArrow(count, ENTRIES).withColumn("bucket", bucket_of(F.col("term")))


def _segment(lake: Lake, news: DataFrame, seg: str, text_col: str) -> tuple[dict, int, int]:
    """Write a segment; returns its partitions, and the number and whole length of its articles."""
    changes = {"docs": {f"{f}@{seg}": seg for f in lake.stage(_documents(news, text_col, seg), "docs", "bucket", seg)}}
    if not changes["docs"]:
        return {}, 0, 0
    docs = lake.staged("docs", None, seg)
    staged = lake.stage(_postings(docs, text_col).select(*_names(POSTINGS)), "postings", "bucket", seg)
    changes["postings"] = {f"{f}@{seg}": seg for f in staged}
    total = docs.agg(F.count("*").alias("n"), F.sum("dl").cast("long").alias("dl")).first()
    return changes, total.n, total.dl or 0


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _without_dead(rows: DataFrame, dead: DataFrame) -> DataFrame:
    return rows.join(dead, ["news_id", "seg"], "left_anti")


def refresh(
    spark: SparkSession, news: DataFrame, root: str, text_col: str = "body", source: str = "", batch_id: int | None = None
) -> None:
    """Add a batch of articles as a segment; older versions of them are dead from then on.

    Articles without an id have no older versions and are told apart by nothing; they are left out.
    """
    lake, seg = Lake(spark, root), uuid.uuid4().hex
    if lake.done(source, batch_id):
        return
    latest = latest_version(news.where("news_id is not null"), ["news_id"], ["published_at"])
    state = lake.state()
    changes, n, dl = _segment(lake, latest, seg, text_col)
    gone = None
    if n and state.tables.get("docs"):
        fresh = lake.staged("docs", None, seg).select("news_id", "bucket")
        asked = [folder("bucket", r.bucket) for r in fresh.select("bucket").distinct().collect()]  # at most ID_BUCKETS
        held = _without_dead(lake.read("docs", None, asked), lake.read("dead", DEAD))
        old = held.join(fresh.select("news_id"), "news_id", "left_semi").select("news_id", "seg", "dl", F.col(text_col).alias("text")).persist()
        gone = old.groupBy("seg").agg(F.count("*").alias("n"), F.sum("dl").cast("long").alias("dl")).collect()  # a row a segment
        if gone:
            changes["dead"] = {f"{f}@{seg}": seg for f in lake.stage(old.select("news_id", "seg"), "dead", "seg", seg)}
            terms = old.select("seg", F.explode(F.array_distinct(tokens(F.col("text")))).alias("term"))
            counts = terms.groupBy("seg", "term").agg(F.count("*").alias("n"))
            changes["dead_terms"] = {f"{f}@{seg}": seg for f in lake.stage(counts.select("term", "n", "seg"), "dead_terms", "seg", seg)}
        old.unpersist()
    numbers = {f"n:{r.seg}": state.numbers[f"n:{r.seg}"] - r.n for r in gone or []}
    numbers |= {"n": state.numbers.get("n", 0) + n - sum(r.n for r in gone or []), "dl": state.numbers.get("dl", 0) + dl - sum(r.dl for r in gone or [])}
    if n:
        numbers[f"n:{seg}"] = n
    lake.publish(changes, source, batch_id, **numbers)
    merge(spark, root, text_col)


def segment_sizes(lake: Lake) -> dict[str, int]:
    return {k[2:]: n for k, n in lake.state().numbers.items() if k.startswith("n:")}


def merge(spark: SparkSession, root: str, text_col: str = "body") -> None:
    """Merge segments of like size while FAN of them are; dead articles go with it."""
    lake = Lake(spark, root)
    while True:
        tiers: dict[int, list[str]] = {}
        for seg, n in segment_sizes(lake).items():
            tiers.setdefault(int(math.log(max(n, 1), FAN)), []).append(seg)
        full = [segs for _, segs in sorted(tiers.items()) if len(segs) >= FAN]
        if not full:
            return
        old, seg = set(full[0]), uuid.uuid4().hex
        live = lake.state().tables
        docs = _without_dead(lake.read("docs").where(F.col("seg").isin(list(old))), lake.read("dead", DEAD))
        changes, n, _ = _segment(lake, docs.drop("seg", "block", "dl", "bucket"), seg, text_col)
        for table, names in live.items():
            for name, version in names.items():
                owner = name.split("@")[0].removeprefix("seg=") if table.startswith("dead") else version
                if owner in old:
                    changes.setdefault(table, {})[name] = None
        numbers = {f"n:{s}": None for s in old} | ({f"n:{seg}": n} if n else {})
        lake.publish(changes, **numbers)


class Search:
    """One search over the stored index; `bounds`, `first` and `rest` tell which blocks were looked at."""

    def __init__(self, spark: SparkSession, root: str, queries: DataFrame, k: int):
        self.spark, self.k = spark, k
        self.lake = Lake(spark, root)
        wanted = query_terms(queries)
        self.restricted = "ticker" in wanted.columns
        terms = wanted.select("term").distinct()
        small = fits(wanted, BROADCAST_TERMS)
        # At most as many numbers as there are buckets; they choose the folders that are read.
        buckets = [folder("bucket", r.b) for r in terms.select(bucket_of(F.col("term")).alias("b")).distinct().collect()]
        postings = self.lake.read("postings", POSTINGS, buckets).drop("bucket")
        self.postings = postings.join(F.broadcast(terms) if small else terms, "term", "left_semi")
        numbers = self.lake.state().numbers
        self.n, self.mean = numbers.get("n", 0), numbers.get("dl", 0) / max(numbers.get("n", 0), 1)

        less = self.lake.read("dead_terms", DEAD_TERMS).join(terms, "term", "left_semi").select("term", (-F.col("n")).alias("n"))
        df = self.postings.select("term", "n").unionByName(less).groupBy("term").agg(F.sum("n").alias("df")).where("df > 0")
        idf = F.log(F.lit(1.0) + (self.n - F.col("df") + 0.5) / (F.col("df") + 0.5))
        self.weighted = self._kept(wanted.join(df, "term").withColumn("idf", idf).drop("df"), "weighted")
        self.weighted_hint = F.broadcast(self.weighted) if small else self.weighted
        self.bounds = self._kept(self._bounds(), "bounds")
        best = Window.partitionBy("query_id").orderBy(F.desc("bound"), "seg", "block")
        self.first = self.bounds.withColumn("r", F.row_number().over(best)).where(F.col("r") <= FIRST_BLOCKS).drop("r")
        self.scored = self._kept(self._scores(self.first), "scored")
        ranked = self.scored.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "news_id")))
        kth = ranked.where(F.col("r") == k).select("query_id", F.col("score").alias("kth"))
        rest = self.bounds.join(self.first.select("query_id", "seg", "block"), ["query_id", "seg", "block"], "left_anti")
        # Scores are rounded, so a bound may be short of one by half of the last place.
        self.rest = rest.join(kth, "query_id", "left").where(F.col("kth").isNull() | (F.col("bound") + 1e-6 >= F.col("kth"))).drop("kth")

    def _kept(self, df: DataFrame, purpose: str) -> DataFrame:
        path = scratch_dir(self.spark, purpose)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _share(self, tf: str, dl: str):
        norm = F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col(dl) / self.mean)
        return F.col("idf") * F.col(tf) * F.lit(K1 + 1) / (F.col(tf) + norm)

    def _bounds(self) -> DataFrame:
        """(query_id, seg, block, bound): no article of the block scores more."""
        on = ["term", "ticker"] if self.restricted else ["term"]
        rows = self.postings.select("seg", "block", "ticker", "term", "max_tf", "min_dl")
        met = (rows if self.restricted else rows.drop("ticker")).join(self.weighted_hint, on)
        return met.groupBy("query_id", "seg", "block").agg(F.sum(self._share("max_tf", "min_dl")).alias("bound"))

    def _scores(self, pairs: DataFrame) -> DataFrame:
        """(query_id, seg, news_id, score) of all live articles in (query_id, seg, block)."""
        asked = pairs.select("query_id", "seg", "block").join(self.weighted_hint, "query_id")
        on = ["seg", "block", "term", *(["ticker"] if self.restricted else [])]
        rows = self.postings.select(*on, "ids", "tfs", "dls").join(asked, on)
        parts = rows.select("query_id", "seg", "block", "idf", F.inline(F.arrays_zip("ids", "tfs", "dls"))).withColumnsRenamed(
            {"ids": "news_id", "tfs": "tf", "dls": "dl"}
        )
        parts = _without_dead(parts, self.lake.read("dead", DEAD))
        total = F.round(F.sum(self._share("tf", "dl")), 6).alias("score")
        return parts.groupBy("seg", "block", "query_id", "news_id").agg(total).drop("block")

    def top(self, columns: list[str]) -> DataFrame:
        if not self.n:
            return self.weighted.select("query_id").where("false").selectExpr(
                "query_id", "0 AS rank", "'' AS news_id", "0D AS score", *[f"NULL AS `{c}`" for c in columns]
            )
        every = self.scored.unionByName(self._scores(self.rest))
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "news_id")
        top = every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= self.k)
        attributes = self.lake.read("docs").select("news_id", "seg", *columns)
        return top.join(attributes, ["news_id", "seg"]).select("query_id", "rank", "news_id", "score", *columns)


def search(spark: SparkSession, root: str, queries: DataFrame, k: int = 5, columns: list[str] | None = None) -> DataFrame:
    """Top k articles per query; `queries` has (query_id, query) and optionally a `ticker` to restrict to."""
    return Search(spark, root, queries, k).top(["headline", "ticker"] if columns is None else columns)
