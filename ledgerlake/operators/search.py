"""Full-text search: an inverted index and BM25 ranking for a batch of queries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.functions.tokens import tokens
from ledgerlake.operators.skew import fits, lookup_join

K1 = 1.2
B = 0.75
BUCKETS = 64
PAIRS_PER_TASK = 1 << 19  # (article, query) pairs whose scores a task holds


@dataclass(frozen=True)
class Index:
    """postings: (news_id, ticker, dl, term, tf, bucket); docs: attributes and length `dl` per news_id."""

    postings: DataFrame
    docs: DataFrame


def bucket_of(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def build_index(news: DataFrame, text_col: str = "body") -> Index:
    """Count every article's terms; texts stay where they are read, only counted terms are shuffled."""
    cut = news.withColumn("_tokens", tokens(F.col(text_col))).withColumn("dl", F.size("_tokens"))
    postings = (
        cut.select("news_id", "ticker", "dl", F.explode("_tokens").alias("term"))
        .groupBy("news_id", "ticker", "dl", "term")
        .agg(F.count("*").alias("tf"))
        .withColumn("bucket", bucket_of(F.col("term")))
    )
    return Index(postings, cut.drop("_tokens"))


def write_index(index: Index, path: str, part: str = "batch_id=0") -> None:
    """Postings are stored by term bucket, so a question reads the buckets of its terms only."""
    postings = index.postings.hint("rebalance", "bucket")
    postings.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings/{part}")
    index.docs.write.mode("overwrite").parquet(f"{path}/docs/{part}")


def read_index(spark: SparkSession, path: str) -> Index:
    """The index with the newest version of every article.

    An article that was sent again has rows in several batches; those of older batches are left
    out by an anti-join with the list of replaced versions, which is as short as the re-sends.
    """
    docs, postings = spark.read.parquet(f"{path}/docs"), spark.read.parquet(f"{path}/postings")
    newest = docs.groupBy("news_id").agg(F.max("batch_id").alias("newest"), F.count("*").alias("versions"))
    resent = newest.where("versions > 1").drop("versions")
    old = docs.select("news_id", "batch_id").join(resent, "news_id").where("batch_id < newest").drop("newest")
    key = ["news_id", "batch_id"]
    return Index(
        postings.join(old, key, "left_anti").drop("batch_id"), docs.join(old, key, "left_anti").drop("batch_id")
    )


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, term) with each term once per query; keeps a `ticker` restriction if present."""
    keep = [c for c in ("query_id", "ticker") if c in queries.columns]
    return queries.select(*keep, F.explode(F.array_distinct(tokens(F.col("query")))).alias("term"))


def score(index: Index, queries: DataFrame, max_query_terms: int = 200_000) -> DataFrame:
    """(query_id, news_id, score) for every article that shares a term with the query.

    Postings of queried terms are placed by article, in as many parts as the number of articles times
    that of queries asks for, so what a task holds does not grow with the corpus. Query terms are broadcast while their
    number stays within `max_query_terms`, so an article meets all queries in one task and its
    scores are summed without a further shuffle; a larger batch is joined by shuffle with hot
    terms spread over salts. With a `ticker` in the queries only articles of it are scored.
    """
    wanted = query_terms(queries)
    terms = wanted.select("term").distinct()
    small = fits(wanted, max_query_terms)
    # At most BUCKETS numbers; as literals they prune the folders that are read.
    buckets = [r.b for r in terms.select(bucket_of(F.col("term")).alias("b")).distinct().collect()]
    relevant = index.postings.where(F.col("bucket").isin(buckets)).drop("bucket").join(F.broadcast(terms) if small else terms, "term", "left_semi")
    pairs = index.docs.count() * wanted.select("query_id").distinct().count()
    width = int(index.postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = relevant.repartition(max(width, -(-pairs // PAIRS_PER_TASK)), "news_id")
    # Document frequency of the queried terms only; counts combine map-side.
    df = relevant.groupBy("term").agg(F.count("*").alias("df"))
    corpus = index.docs.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"))
    n, avgdl = corpus.select("n").scalar(), corpus.select("avgdl").scalar()
    idf = F.log(F.lit(1.0) + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = wanted.join(df, "term").withColumn("idf", idf).drop("df")

    on = ["term", "ticker"] if "ticker" in wanted.columns else ["term"]
    rows = placed if "ticker" in wanted.columns else placed.drop("ticker")
    if small:
        pairs = rows.join(F.broadcast(weighted), on)
    else:
        pairs = lookup_join(rows, weighted, on, spread_by="news_id", max_broadcast_rows=max_query_terms)
    norm = F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col("dl") / avgdl)
    part = F.col("idf") * F.col("tf") * F.lit(K1 + 1) / (F.col("tf") + norm)
    return pairs.groupBy("news_id", "query_id").agg(F.round(F.sum(part), 6).alias("score"))


def search(
    index: Index,
    queries: DataFrame,
    k: int = 5,
    columns: list[str] | None = None,
) -> DataFrame:
    """Top k articles per query with the chosen attributes.

    `queries` has (query_id, query) and optionally a `ticker` the article must carry.
    """
    columns = columns if columns is not None else ["headline", "ticker"]
    ranked = score(index, queries)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("news_id"))
    top = ranked.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    attributes = index.docs.select("news_id", *columns)
    return top.join(attributes, "news_id").select("query_id", "rank", "news_id", "score", *columns)
