"""Training-corpus pipeline over documents: five stages, each written as Parquet and read again.

Every stage works on all rows its predecessor kept, and all but the last return the columns they
were given. Rows travel as one struct, so further columns may have any name.

* toxicity: documents predicted toxic go.
* near_duplicates: of each component of linked documents the smallest id stays, once.
* decontamination: documents that contain a benchmark item go.
* personal_data: spans are replaced by their kind; n_chars follows.
* bpe: token counts and digests of the ids and the decoded text.

Rows without an id pass near_duplicates, which links ids; the stages that look at texts treat them
as all others. Rows that share id and text are one document, unlike texts under one id are documents
of their own. Benchmark items without an id count like those with one. Further columns may have any
type that Parquet stores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import bpe, decontaminate, jaccard, pii, toxicity
from ledgerlake.llm.common import bounded_memory, doc_key, small, stored

ORACLE_SQL = None


def _row(docs: DataFrame):
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row_")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_memory(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    # Only keys and texts pass through the scoring; the rows meet the list of toxic ones where they are.
    key = doc_key("doc_id", "text")
    scored = model.score(docs.select(*key, "text")).where("predicted = 1")
    goes = stored(scored.select(F.col("k_id").alias("t_id"), F.col("k_text").alias("t_text")).distinct(), "toxic")
    same = F.col("k_id").eqNullSafe(F.col("t_id")) & (F.col("k_text") == F.col("t_text"))
    rows = docs.select(_row(docs), *key)
    return rows.join(small(goes, goes.count(), 24), same, "left_anti").select("row_.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_memory(spark)
    key_id, key_text = doc_key("doc_id", "text")
    rows = docs.select(_row(docs), key_id.cast("long").alias("k_id"), key_text)
    texts = rows.where("k_id is not null").select("k_id", "k_text").distinct()
    clashing = stored(texts.groupBy("k_id").count().where("count > 1").select(F.col("k_id").alias("c_id")), "clashing")
    n = clashing.count()
    node = F.col("k_id")
    if n:  # unlike texts under one id are documents of their own; real ids come before theirs
        rows = rows.join(small(clashing, n, 16), F.col("k_id") == F.col("c_id"), "left")
        own = F.shiftrightunsigned(F.xxhash64("k_id", "k_text"), 2).bitwiseOR(F.lit(1 << 62))
        node = F.when(F.col("c_id").isNotNull(), own).otherwise(node)
    rows = rows.select("row_", node.alias("node"))
    found = jaccard.jaccard_components(rows.select("node", F.col("row_.text").alias("text")), "node")
    found = stored(found.where("id is not null"), "components")
    goes = found.where("id != component_id").select(F.col("id").alias("id_")).distinct()
    rows = rows.join(small(goes, goes.count(), 16), F.col("node") == F.col("id_"), "left_anti")
    repeated = stored(found.groupBy("id").count().where("count > 1").select(F.col("id").alias("id_")), "repeated")
    n = repeated.count()
    if n:  # rows of one id and text are one document; the first as JSON stays, as not every type has an order
        same = F.col("node") == F.col("id_")
        again = rows.join(small(repeated, n, 16), same, "left_semi").groupBy("node").agg(F.min_by("row_", F.to_json("row_")).alias("row_"))
        rows = rows.join(small(repeated, n, 16), same, "left_anti").unionByName(again.select("row_", "node"))
    return rows.select("row_.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_memory(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    own = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))  # stands in for a missing id
    items = items.select(F.coalesce(F.col("item_id").cast("long"), own).alias("item_id"), "text")
    pairs = decontaminate.contaminated(docs, items)
    goes = stored(pairs.select("k_id", "k_text").distinct(), "contaminated")
    rows = docs.select(_row(docs), *[c.alias(f"{n}_") for c, n in zip(doc_key("doc_id", "text"), ("id", "hash"))])
    same = F.col("id_").eqNullSafe(F.col("k_id")) & (F.col("hash_") == F.col("k_text"))
    return rows.join(small(goes, goes.count(), 24), same, "left_anti").select("row_.*")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_memory(spark)
    spans = pii.personal_data(docs).select("k_id", "k_text", F.concat("spans", "added").alias("spans_"))
    spans = stored(spans.where(F.size("spans_") > 0).dropDuplicates(["k_id", "k_text"]), "spans")
    rows = docs.select(_row(docs), *[c.alias(f"{n}_") for c, n in zip(doc_key("doc_id", "text"), ("id", "hash"))])
    same = F.col("id_").eqNullSafe(F.col("k_id")) & (F.col("hash_") == F.col("k_text"))
    rows = rows.join(small(spans, spans.count(), 128), same, "left")
    text = F.when(F.col("spans_").isNull(), F.col("row_.text")).otherwise(pii.masked(F.col("row_.text"), F.col("spans_")))
    rows = rows.withColumn("text_", text)
    size = F.when(F.col("spans_").isNull(), F.col("row_.n_chars")).otherwise(F.length("text_")).cast("long") if "n_chars" in docs.columns else None
    new = {"text": F.col("text_"), "n_chars": size}
    return rows.select(*[new.get(c, F.col(f"row_.`{c}`")).alias(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
