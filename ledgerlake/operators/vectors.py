"""Text embeddings by feature hashing and exact nearest neighbours by cosine."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.functions.tokens import tokens

# The batch functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIMS = 768
SHARD_ROWS = 8_192  # vectors of a shard, which a task holds as a matrix
TARGETS_AT_ONCE = 256


def hash_sample(df: DataFrame, n: int, key: str = "txn_id") -> DataFrame:
    """A repeatable sample of n rows."""
    return df.orderBy(F.md5(F.col(key)), key).limit(n)


# The columns of the stored pool.
POOL_COLUMNS = [
    "txn_id", "txn_text", "amount", "category", "merchant", "city", "country", "channel", "is_fraud_label",
]


def vector_pool(scored: DataFrame, features: DataFrame, n: int = 1000) -> DataFrame:
    """Every reviewed transaction and a sample of all of them, each row once."""
    return scored.select(*POOL_COLUMNS).union(hash_sample(features, n).select(*POOL_COLUMNS)).distinct()


def _slot(token: str, dims: int) -> tuple[int, float]:
    head = int(hashlib.md5(token.encode()).hexdigest()[:8], 16)
    return head % dims, (1.0 if (head // dims) % 2 == 0 else -1.0)


def _as_matrix(column: pa.Array) -> np.ndarray:
    """List column of equal lengths to a matrix without touching single values."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _scattered(batch: pa.Array, dims: int) -> np.ndarray:
    """Lists of tokens to signed counts in `dims` slots, a row of length 1 for each list (0 without tokens)."""
    out = np.zeros((len(batch), dims))
    words = batch.flatten()
    if len(words):
        row = np.repeat(np.arange(len(batch)), pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False))
        coded = words.dictionary_encode()
        slots = np.array([_slot(t, dims) for t in coded.dictionary.to_pylist()])
        code = coded.indices.to_numpy(zero_copy_only=False)
        np.add.at(out, (row, slots[code, 0].astype(int)), slots[code, 1])
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, norm, out=out, where=norm > 0).astype(np.float32)


def embed(df: DataFrame, text_col: str, dims: int = DIMS) -> DataFrame:
    """Adds `embedding`: signed token counts hashed into `dims` slots, with length 1.

    Tokens are cut JVM-side; the Arrow function scatters a batch at a time and hashes each
    distinct token of the batch once.
    """

    @F.arrow_udf("array<float>")
    def scatter(batch: pa.Array) -> pa.Array:
        unit = _scattered(batch, dims)
        offsets = np.arange(len(batch) + 1, dtype=np.int32) * dims
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(unit.ravel()))

    return df.withColumn("embedding", scatter(tokens(F.coalesce(F.col(text_col), F.lit("")))))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two float arrays in double precision; NULL when one has no length."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(
            F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")),
            F.lit(0.0), lambda s, v: s + v,
        )

    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def _top_of_part(ids: np.ndarray, sims: np.ndarray, targets: list[str], k: int) -> list[tuple]:
    """Best k ids per target within a batch, by (similarity desc, id)."""
    found = []
    for j, target in enumerate(targets):
        s = sims[:, j]
        pick = np.flatnonzero(~np.isnan(s) & (ids != target))
        if len(pick) > k:
            floor = np.partition(s[pick], len(pick) - k)[len(pick) - k]
            pick = pick[s[pick] >= floor]
        order = pick[np.lexsort((ids[pick], -s[pick]))][:k]
        found += [(target, ids[i], float(s[i])) for i in order]
    return found


def _codes(matrix: np.ndarray, tables: int, bits: int, seed: int = 11) -> np.ndarray:
    """For each of `tables` sets of random hyperplanes the sides a row lies on, as a number."""
    planes = np.random.default_rng(seed).normal(size=(matrix.shape[1], tables * bits)).astype(np.float32)
    sides = (matrix.astype(np.float32) @ planes > 0).reshape(len(matrix), tables, bits)
    return (sides * (1 << np.arange(bits))).sum(axis=2)


def _nearest_in_shards(
    vectors: DataFrame, targets: DataFrame, k: int, shards: int, id_type: str,
    dims: int | None = None, buckets: tuple[int, int, int] | None = None,
) -> DataFrame:
    """The k best of every shard for every target: a task holds one shard and one batch of targets.

    Each row is moved once, targets are copied to the shards. Rows of a shard come first in its
    partition, so its matrix is complete when the targets stream past. With `dims`, `vec` is a text:
    texts are moved and become vectors of `dims` slots in the task, so that no dense vector is shuffled.
    With `buckets` (tables, bits, rows at once) only rows that share a bucket of a hash table with a
    target are compared with it.
    """
    rows = vectors.select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("asks"), "id", "vec")
    copies = targets.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("asks"), "id", "vec")
    dealt = rows.unionByName(copies).repartition(shards, "shard").sortWithinPartitions("shard", "asks")

    def given(column: pa.Array) -> np.ndarray:
        return _as_matrix(column) if dims is None else _scattered(column, dims)

    def unit(v: np.ndarray) -> np.ndarray:
        v = v.astype(np.float64)
        size = np.linalg.norm(v, axis=1, keepdims=True)
        return np.divide(v, size, out=np.full_like(v, np.nan), where=size > 0)

    def compared(matrix: np.ndarray, codes: np.ndarray | None, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, similarity of each to each target); NaN where they share no bucket."""
        if buckets is None:
            return np.arange(len(matrix)), np.round(matrix @ unit(asked).T, 6)
        tables, bits, at_once = buckets
        wanted = _codes(asked, tables, bits)
        met = np.zeros((len(matrix), len(asked)), dtype=bool)
        for t in range(tables):
            met |= codes[:, t, None] == wanted[None, :, t]
        reached = np.flatnonzero(met.any(axis=1))
        sims = np.empty((len(reached), len(asked)))
        for at in range(0, len(reached), at_once):
            few = reached[at : at + at_once]
            sims[at : at + at_once] = np.round(matrix[few] @ unit(asked).T, 6)
        return reached, np.where(met[reached], sims, np.nan)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        matrix, codes, ids, number = None, None, None, None
        for batch in batches:
            shard = np.asarray(batch.column(0))
            asks = np.asarray(batch.column(1).cast(pa.int8()))
            cuts = np.flatnonzero((shard[1:] != shard[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if shard[a] != number:
                    held, matrix, number = [], None, shard[a]
                if not asks[a]:
                    held.append(part)
                    continue
                if matrix is None and held:
                    whole = pa.Table.from_batches(held)
                    matrix = given(whole["vec"].combine_chunks())
                    codes = _codes(matrix, *buckets[:2]) if buckets else None
                    matrix = unit(matrix)
                    ids = whole["id"].to_numpy()
                    held = []
                if matrix is None:
                    continue
                for at in range(0, part.num_rows, TARGETS_AT_ONCE):
                    few = part.slice(at, TARGETS_AT_ONCE)
                    rows, sims = compared(matrix, codes, given(few.column(3)))
                    found = _top_of_part(ids[rows], sims, few.column(2).to_pylist(), k)
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["target_id", "id", "similarity"])

    # Texts are cut into tokens after the shuffle.
    vec = F.col("vec") if dims is None else tokens(F.coalesce("vec", F.lit(""))).alias("vec")
    return dealt.select("shard", "asks", "id", vec).mapInArrow(scan, f"target_id {id_type}, id {id_type}, similarity double")


def _sides(vectors: DataFrame, targets: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """(id, vec) of the vectors and of the targets, which are ids of `vectors` or bring their own."""
    src = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).where("vec is not null")
    if vec_col in targets.columns:
        return src, targets.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).where("vec is not null")
    return src, src.join(targets.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi")


def _shards(vectors: DataFrame) -> int:
    return max(vectors.sparkSession.sparkContext.defaultParallelism, -(-vectors.count() // SHARD_ROWS))


def _ranked(found: DataFrame, vectors: DataFrame, k: int, id_col: str, columns: list[str] | None) -> DataFrame:
    """The first k of each target by similarity and id, with attributes of the vectors."""
    order = Window.partitionBy("target_id").orderBy(F.desc("similarity"), F.asc("id"))
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    extra = columns or []
    if not extra:
        return top.select("target_id", F.col("id").alias(id_col), "similarity", "rank")
    attributes = vectors.select(F.col(id_col).alias("id"), *extra)
    return top.join(attributes, "id").select("target_id", F.col("id").alias(id_col), "similarity", "rank", *extra)


def similar(
    vectors: DataFrame,
    targets: DataFrame,
    k: int = 5,
    id_col: str = "txn_id",
    vec_col: str = "embedding",
    columns: list[str] | None = None,
    text_col: str | None = None,
    dims: int = DIMS,
) -> DataFrame:
    """Exact top k neighbours of each target by cosine over all vectors, the target excluded.

    Targets are ids of `vectors`, or bring their own `vec_col`. Vectors are dealt into shards of about
    SHARD_ROWS and targets stream past each shard as matrix products; a shard keeps k rows per
    target, so only those move on. Neither side passes through the driver, and any number of
    targets takes one scan of the vectors. With `text_col` in place of `vec_col` the vectors are those
    that embed() gives the texts; they are made in the shards, so only texts are shuffled.
    """
    id_type = vectors.schema[id_col].dataType.simpleString()
    src, chosen = _sides(vectors, targets, id_col, text_col or vec_col)
    found = _nearest_in_shards(src, chosen, k, _shards(vectors), id_type, dims if text_col else None)
    return _ranked(found, vectors, k, id_col, columns)


def hash_tables(rows: DataFrame, tables: int, bits: int, dims: int, seed: int = 11) -> DataFrame:
    """(id, vec, codes): for each of `tables` sets of random hyperplanes the sides a vector lies on, as a number."""

    @F.arrow_udf("array<long>")
    def codes(batch: pa.Array) -> pa.Array:
        values = _codes(_as_matrix(batch).reshape(len(batch), dims), tables, bits, seed)
        return pa.ListArray.from_arrays(np.arange(0, values.size + 1, tables, dtype=np.int32), values.ravel().astype(np.int64))

    return rows.withColumn("codes", codes("vec"))


def candidate_pairs(entries: DataFrame, asked: DataFrame, hot: int) -> DataFrame:
    """(target_id, id) that share a bucket; entries: table, bucket, id; asked: table, bucket, target_id.

    A bucket of more than `hot` entries is dealt into parts, and its targets are copied to each, so no
    task receives a crowded bucket whole.
    """
    key = ["table", "bucket"]
    reached = entries.join(asked.select(*key).distinct(), key, "left_semi")
    parts = reached.groupBy(*key).agg(F.ceil(F.count("*") / hot).cast("int").alias("parts"))
    crowded = parts.where("parts > 1")
    one = F.coalesce("parts", F.lit(1))
    rows = reached.join(crowded, key, "left").withColumn("part", F.pmod(F.xxhash64("id"), one.cast("long")).cast("int")).drop("parts")
    copies = asked.join(crowded, key, "left").withColumn("part", F.explode(F.sequence(F.lit(0), one - 1))).drop("parts")
    return rows.join(copies, [*key, "part"]).where("id != target_id").select("target_id", "id").distinct()


def similar_candidates(
    vectors: DataFrame,
    targets: DataFrame,
    k: int = 5,
    id_col: str = "txn_id",
    vec_col: str = "embedding",
    columns: list[str] | None = None,
    dims: int = DIMS,
    tables: int = 24,
    bits: int = 8,
    hot: int = 4_096,
    text_col: str | None = None,
) -> DataFrame:
    """Top k neighbours of each target among the vectors that share a bucket with it, ranked exactly.

    Random hyperplanes put a vector into one bucket of each table; two of an angle a share the bucket
    of a table with probability (1 - a / pi) ** bits. Each shard of similar() has hash tables of its own
    vectors, and targets stream past them: pairs that share a bucket meet inside the shard, at most
    `hot` rows at once, and only the k best of each target leave it. So no table of pairs is made, and no
    vector is fetched for one. More tables find more, more bits compare less. The result is that of
    similar() for the neighbours that were met; `text_col` is as there.
    """
    id_type = vectors.schema[id_col].dataType.simpleString()
    src, chosen = _sides(vectors, targets, id_col, text_col or vec_col)
    found = _nearest_in_shards(src, chosen, k, _shards(vectors), id_type, dims if text_col else None, (tables, bits, hot))
    return _ranked(found, vectors, k, id_col, columns)


def unit_vectors(vectors: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """Adds `unit`: the vector with length 1 in double precision; null for a zero vector."""
    length = F.sqrt(F.aggregate(vec_col, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    # Through an array of one, the length is computed once a vector and not once a component.
    unit = F.transform(F.array(length), lambda n: F.when(n > 0, F.transform(vec_col, lambda x: x.cast("double") / n)))
    return vectors.withColumn("unit", unit[0])


def register_similar_function(spark: SparkSession, vectors: DataFrame, k: int = 5) -> None:
    """SQL table function similar_txns(target_id) over stored vectors.

    The vectors are scanned once: the target's unit vector comes in by an equi-join on the id that
    every row is compared with, so no plan has a product of the table with itself.
    """
    unit_vectors(vectors).createOrReplaceTempView("txn_vectors")
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION similar_txns(target_id STRING)
        RETURNS TABLE (txn_id STRING, similarity DOUBLE, txn_text STRING, amount DOUBLE,
                       category STRING, is_fraud_label BOOLEAN)
        RETURN
          WITH wanted AS (SELECT txn_id AS wanted_id, unit AS wanted_unit FROM txn_vectors WHERE txn_id = target_id),
          compared AS (
            SELECT *, round(reduce(zip_with(unit, wanted_unit, (p, q) -> p * q), 0D, (sum, pq) -> sum + pq), 6) AS similarity
            FROM (SELECT *, target_id AS wanted_id FROM txn_vectors WHERE txn_id != target_id) JOIN wanted USING (wanted_id))
          SELECT txn_id, similarity, txn_text, amount, category, is_fraud_label
          FROM compared ORDER BY similarity DESC NULLS LAST, txn_id LIMIT {k}
        """
    )
    # The same with the target's unit vector as an argument, to be called laterally for many targets:
    # the call is turned into one scan of the vectors that meets all targets.
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION similar_to(target_id STRING, target_unit ARRAY<DOUBLE>)
        RETURNS TABLE (txn_id STRING, similarity DOUBLE, txn_text STRING, amount DOUBLE,
                       category STRING, is_fraud_label BOOLEAN)
        RETURN
          SELECT txn_id, round(reduce(zip_with(unit, target_unit, (p, q) -> p * q), 0D, (sum, pq) -> sum + pq), 6) AS similarity,
                 txn_text, amount, category, is_fraud_label
          FROM txn_vectors WHERE txn_id != target_id
          ORDER BY similarity DESC NULLS LAST, txn_id LIMIT {k}
        """
    )


def similar_lateral(spark: SparkSession, targets: DataFrame) -> DataFrame:
    """similar_to() called laterally for every row of a table of targets (txn_id, unit)."""
    targets.select("txn_id", "unit").createOrReplaceTempView("similar_targets")
    return spark.sql(
        """
        SELECT t.txn_id AS target_id, s.txn_id, s.similarity, s.txn_text, s.amount, s.category, s.is_fraud_label
        FROM similar_targets t, LATERAL similar_to(t.txn_id, t.unit) s
        """
    )
