"""Approximate nearest neighbours by multi-index hashing.

Codes: vectors are centred and turned by a rotation that is learned (iterative quantisation) on a
sample of at most FIT_ROWS vectors; the signs are the bits. A code is cut into substrings of at
most 16 bits, and each is indexed: rows sorted by substring value. Two codes within a Hamming radius
R agree in one of m substrings up to R // m bits, so probing all values in that ball of each
substring retrieves every code within R. Retrieved rows are ranked by the exact distance.

The radius is learned on the same sample: within it lie RECALL of the sample's own true neighbours.
Where fewer than k rows lie within it for a query, its radius grows until they do.

Placement: every vector is indexed, in shards of about SHARD_ROWS; queries are copied to the shards and
stream past them, and a shard returns k rows a query. Equal vectors are one index entry that
keeps their k + 1 smallest ids (more cannot be among k neighbours), so a vector that a third of
the rows share costs one entry.

Defined cases: vectors that are null, zero, hold null or non-finite components, or have another
length than most take no part; ties go to the smaller id; rows that repeat id and vector count
once; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import stored

FIT_ROWS = 8_000
FIT_QUERIES = 250
SHARD_ROWS = 16_384
RECALL = 0.985
SUBSTRING = 16


@dataclass
class Code:
    mean: np.ndarray
    turn: np.ndarray
    radius: int

    def bits(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.turn > 0


def learn(sample: np.ndarray, k: int, rounds: int = 30) -> Code:
    """Principal axes, then the rotation between signs and values that loses least; the radius by recall."""
    mean = sample.mean(axis=0)
    centred = sample - mean
    axes = np.linalg.svd(centred.T @ centred)[0]
    values = centred @ axes
    dim = values.shape[1]
    turn = np.linalg.qr(np.random.default_rng(7).normal(size=(dim, dim)))[0]
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.where(values @ turn > 0, 1.0, -1.0).T @ values)
        turn = (left @ right).T
    code = Code(mean, axes @ turn, dim)
    bits = code.bits(sample)
    distances = []
    for i in range(min(FIT_QUERIES, len(sample))):
        far = ((sample - sample[i]) ** 2).sum(axis=1)
        far[i] = np.inf
        near = np.argpartition(far, min(k, len(far) - 1))[:k]
        distances.append((bits[near] != bits[i]).sum(axis=1))
    code.radius = int(np.quantile(np.concatenate(distances), RECALL)) if distances else dim
    return code


class Shard:
    """Substring tables over the codes of a shard."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.packed = np.packbits(bits, axis=1)
        self.cuts = [range(a, min(a + SUBSTRING, bits.shape[1])) for a in range(0, bits.shape[1], SUBSTRING)]
        self.orders, self.starts = [], []
        for cut in self.cuts:
            values = self._value(bits[:, cut])
            self.orders.append(np.argsort(values, kind="stable"))
            self.starts.append(np.searchsorted(values[self.orders[-1]], np.arange((1 << len(cut)) + 1)))

    @staticmethod
    def _value(bits: np.ndarray) -> np.ndarray:
        return bits @ (1 << np.arange(bits.shape[1]))

    def within(self, query: np.ndarray, radius: int, balls: dict) -> np.ndarray:
        """All rows whose code lies within radius of the query's, by probing every substring's ball."""
        hit = np.zeros(len(self.bits), bool)
        for cut, order, starts in zip(self.cuts, self.orders, self.starts):
            values = self._value(query[None, cut])[0] ^ ball(len(cut), radius // len(self.cuts), balls)
            size = starts[values + 1] - starts[values]
            values, size = values[size > 0], size[size > 0]
            first = np.repeat(starts[values] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
            hit[order[first + np.arange(len(first))]] = True
        rows = np.flatnonzero(hit)
        away = np.bitwise_count(self.packed[rows] ^ np.packbits(query)).sum(axis=1)
        return rows[away <= radius]


def ball(width: int, radius: int, known: dict) -> np.ndarray:
    """All values of width bits with at most radius ones."""
    if (width, radius) not in known:
        made = [sum(1 << i for i in c) for r in range(min(radius, width) + 1) for c in combinations(range(width), r)]
        known[width, radius] = np.array(made, np.int64)
    return known[width, radius]


def nearest(shard: Shard, code: Code, balls: dict, x: np.ndarray, ids: list, q: int, v: np.ndarray, bits: np.ndarray, k: int) -> list[tuple]:
    """(distance, id) of a shard's k nearest rows that probing retrieves; the radius grows until there are k."""
    radius = min(code.radius, len(bits))
    while True:
        near = shard.within(bits, radius, balls)
        if len(near) > k or radius >= len(bits) or len(near) == len(x):
            break
        radius = min(radius + len(shard.cuts), len(bits))
    far = np.sqrt(((x[near] - v) ** 2).sum(axis=1))
    best = near[far <= np.partition(far, k)[k]] if len(far) > k else near
    dist = dict(zip(near, far))
    return sorted((dist[r], i) for r in best for i in ids[r] if i != q)[:k]


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): the vectors that take part, as doubles."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null")
    rows = rows.where(~F.coalesce(bad, F.lit(False)) & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("v") == (sizes[0].n if sizes else 0))


def search(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query, rank, id, score): for each query the k nearest vectors other than its own.

    Both inputs have the columns id and v (see usable()).
    """
    spark = vectors.sparkSession
    # -0.0 + 0.0 is 0.0, so equal vectors agree in bytes.
    keyed = vectors.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))).distinct()
    first = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    entries = keyed.withColumn("n", first).where(F.col("n") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    entries = stored(entries.withColumn("h", F.xxhash64("v")), "entries")
    total = entries.count()
    schema = "query long, rank int, id long, score double"
    if not total:
        return spark.createDataFrame([], schema)
    share = min(1.0, FIT_ROWS / total)
    sample = entries.where(F.pmod(F.col("h"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("v").limit(2 * FIT_ROWS)
    fitted = spark.sparkContext.broadcast(vars(learn(np.array([r.v for r in sample.collect()]), k)))

    shards = max(spark.sparkContext.defaultParallelism, -(-total // SHARD_ROWS))
    asked = queries.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))).distinct()
    asked = stored(asked.groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("owners")).select("v", F.explode("owners").alias("id")), "queries")
    # Vectors are moved once, to their shard; queries are copied to the shards and stream past them.
    kind = "shard int, asks boolean, id long, ids array<long>, v array<double>"
    base = entries.select(F.pmod("h", F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("asks"), F.lit(None).cast("long").alias("id"), "ids", "v")
    ask = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("asks"), "id", F.lit(None).cast("array<long>").alias("ids"), "v"
    )
    dealt = base.unionByName(ask).repartition(shards, "shard").sortWithinPartitions("shard", "asks")

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, balls = Code(**fitted.value), {}
        held: list[pa.RecordBatch] = []
        shard, number = None, None
        for batch in batches:
            own, asks = np.asarray(batch.column(0)), np.asarray(batch.column(1).cast(pa.int8()))
            cuts = np.flatnonzero((own[1:] != own[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if own[a] != number:
                    held, shard, number = [], None, own[a]
                if not asks[a]:
                    held.append(part)
                    continue
                if shard is None and held:
                    whole = pa.Table.from_batches(held)
                    x, ids, held = matrix(whole["v"].combine_chunks()), whole["ids"].to_pylist(), []
                    shard = Shard(code.bits(x))
                if shard is None:
                    continue
                out, vectors = [], matrix(part.column(4))
                for q, v, bits in zip(part.column(2).to_pylist(), vectors, code.bits(vectors)):
                    out += [(q, i, d) for d, i in nearest(shard, code, balls, x, ids, q, v, bits, k)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["query", "id", "score"])

    found = dealt.select(*[c.split()[0] for c in kind.split(", ")]).mapInArrow(scan, "query long, id long, score double")
    order = F.row_number().over(Window.partitionBy("query").orderBy("score", "id"))
    return found.withColumn("rank", order).where(F.col("rank") <= k).select("query", F.col("rank").cast("int"), "id", "score")


def op10_ann(spark, sf_dir: str) -> DataFrame:
    vectors = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
    found = search(vectors, vectors.where("id % 100 = 0"))
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
