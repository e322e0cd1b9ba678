"""Hard-negative mining by a secondary-sort shuffle.

A row's score for an anchor is the inner product of their quantised vectors. An anchor's positives
are its best rows of the same label; each opens a window of scores below its own, and the best rows
of other labels inside a window are its negatives.

Scoring: vectors stay in shards of about SHARD_ROWS rows, and the anchors stream past them in Arrow
batches, so a task holds one shard and one batch of anchors. A shard returns what can be among an
anchor's first rows, and nothing else: its best positives, and in a second pass, when the windows
are known, its best negatives of each window. Both bounds are exact.

Mining: these pairs are keyed by (anchor, descending score, id), dealt out by anchor and sorted
within partitions. One iterator reads a partition: a positive opens its window, a later row of
another label is emitted for each open window it lies in. It holds the windows of one anchor, at
most as many as positives are asked for, never the anchor's rows.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component take no
part; shorter vectors count as padded with zeros, an empty one scores 0; rows that repeat id,
label and vector count once; rows that share an id but differ are rows (and anchors) of their own,
and never meet each other; ties go to the smaller id; a window of a negative positive score is
empty, that of 0 holds the score 0; scores beyond a long are clipped to its ends; empty
tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import stored

POSITIVES = 5
NEGATIVES = 3
SHARD_ROWS = 32_768
EXACT = 2.0**53
LONG = 2**63 - 1


@dataclass(frozen=True)
class Span:
    """Scores s of negatives with low * p <= 100 * s <= high * p, for a positive's score p.

    high stays under 100, so a positive comes before the rows of its window (but for p = 0).
    """

    low: int = 50
    high: int = 95

    def __post_init__(self):
        if not 0 <= self.low <= self.high < 100:
            raise ValueError("a span needs 0 <= low <= high < 100")

    def bounds(self, p: int) -> tuple[int, int]:
        return -(-self.low * p // 100), self.high * p // 100


def usable(df: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """(id, h, label, v): the rows that take part, v as whole numbers in doubles, h a key of the content."""
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("x"))
    rows = rows.where("id is not null and label is not null and x is not null").where(~F.coalesce(bad, F.lit(False)))
    # Doubles of 2**44 and more times 256 are whole already, and beyond a long; -0.0 becomes 0.0.
    far = F.lit(2.0**1000)
    whole = F.transform("x", lambda c: F.when(F.abs(c) < 2.0**44, F.floor(c * 256).cast("double")).otherwise(F.greatest(F.least(c, far), -far) * 256))
    rows = rows.select("id", "label", F.col("x"), F.transform(whole, lambda c: c + F.lit(0.0)).alias("v")).distinct()
    return rows.select("id", F.xxhash64("label", "x").alias("h"), "label", "v")


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Vectors as rows, padded with zeros to the widest, or cut and padded to width."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = np.asarray(column.offsets)
    flat = np.asarray(column.values)
    size = np.diff(at)
    width = int(size.max(initial=0)) if width is None else width
    out = np.zeros((len(size), width))
    if width and (size == width).all():
        return flat[at[0] : at[-1]].reshape(len(size), width)
    row = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(row)) - np.repeat(np.concatenate([[0], np.cumsum(size)[:-1]]), size)
    inside = place < width
    out[row[inside], place[inside]] = flat[at[0] : at[-1]][inside]
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, as int64; beyond a long they are clipped."""
    top = np.sqrt(EXACT / max(a.shape[1], 1))
    wide = [np.abs(m).max(axis=1, initial=0.0) >= top for m in (a, b)]
    plain = [np.where(w[:, None], 0.0, m) if w.any() else m for w, m in zip(wide, (a, b))]
    out = (plain[0] @ plain[1].T).astype(np.int64)  # each sum stays below 2**53, where doubles are exact
    for i, j in np.argwhere(wide[0][:, None] | wide[1]) if wide[0].any() or wide[1].any() else ():
        out[i, j] = max(-LONG, min(LONG, sum(int(x) * int(y) for x, y in zip(a[i], b[j]))))
    return out


def first(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the n best, by falling score and rising id."""
    if len(scores) > n:
        worst = np.partition(scores, len(scores) - n)[len(scores) - n]
        over = np.flatnonzero(scores > worst)
        level = np.flatnonzero(scores == worst)
        level = level[np.argsort(ids[level], kind="stable")[: n - len(over)]]
        return np.concatenate([over, level])
    return np.arange(len(scores))


@dataclass
class Shard:
    """The rows of a shard, parted by label."""

    ids: np.ndarray
    labels: np.ndarray
    v: np.ndarray

    def positives(self, scores: np.ndarray, own: int, label: int, n: int) -> np.ndarray:
        rows = np.flatnonzero((self.labels == label) & (self.ids != own))
        return rows[first(scores[rows], self.ids[rows], n)]

    def negatives(self, scores: np.ndarray, own: int, label: int, bounds: set[tuple[int, int]], n: int) -> np.ndarray:
        others = (self.labels != label) & (self.ids != own)
        found = []
        for low, high in bounds:
            if low > high:
                continue
            rows = np.flatnonzero(others & (scores >= low) & (scores <= high))
            found.append(rows[first(scores[rows], self.ids[rows], n)])
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


PAIRS = "anchor long, h long, score long, id long, positive boolean"


def _past_shards(rows: DataFrame, anchors: DataFrame, shards: int, mine) -> DataFrame:
    """Streams the anchors past every shard; mine(shard, scores, id, label, levels) gives places and a mark.

    Each vector is moved once; the anchors are copied to the shards, which are few.
    """
    kind = "shard int, anchor boolean, id long, h long, label long, v array<double>, levels array<long>"
    base = rows.select(
        F.pmod(F.xxhash64("id", "h"), F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("anchor"), "id", "h", "label", "v",
        F.lit(None).cast("array<long>").alias("levels"),
    )
    asked = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("anchor"), "id", "h", "label", "v", "levels"
    )
    dealt = base.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "anchor")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard, number = [], None, None
        for batch in batches:
            is_anchor = np.asarray(batch.column(1).cast(pa.int8()))
            own = np.asarray(batch.column(0))
            cuts = np.flatnonzero((own[1:] != own[:-1]) | (is_anchor[1:] != is_anchor[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if own[a] != number:
                    held, shard, number = [], None, own[a]
                if not is_anchor[a]:
                    held.append(part)
                    continue
                if shard is None and held:
                    table = pa.Table.from_batches(held)
                    shard = Shard(np.asarray(table["id"]), np.asarray(table["label"]), matrix(table["v"]))
                    held = []
                if shard is None:
                    continue
                levels = part.column(6).to_pylist()
                for start in range(0, part.num_rows, 64):  # 64 rows of scores at once
                    few = part.slice(start, 64)
                    scores = products(matrix(few.column(5), shard.v.shape[1]), shard.v)
                    out = []
                    for i, (anchor, h, label) in enumerate(zip(*(few.column(c).to_pylist() for c in (2, 3, 4)))):
                        places, mark = mine(shard, scores[i], anchor, label, levels[start + i])
                        if len(places):
                            out.append((np.full(len(places), anchor), np.full(len(places), h), scores[i][places], shard.ids[places], np.full(len(places), mark)))
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["anchor", "h", "score", "id", "positive"])

    return dealt.select(*[c.split()[0] for c in kind.split(", ")]).mapInArrow(scan, PAIRS)


def emitted(rows: Iterator[tuple], span: Span, n: int) -> Iterator[tuple]:
    """(anchor, positive, rank, negative, positive score, negative score) from sorted pairs.

    rows: (anchor, h, score, id, positive), by anchor, h, falling score and id.
    """
    now, open_, zeros = None, [], []
    for anchor, h, score, other, positive in rows:
        if (anchor, h) != now:
            now, open_, zeros = (anchor, h), [], []
        if positive:
            low, high = span.bounds(score)
            if low <= high:
                opened = [low, high, other, score, 0]
                open_.append(opened)
                # Only a score of 0 has its own level in its window; rows before it in id come first.
                for level, negative in zeros:
                    if level == score == 0 and opened[4] < n:
                        opened[4] += 1
                        yield anchor, other, opened[4], negative, score, level
            continue
        if score == 0 and len(zeros) < n:
            zeros.append((score, other))
        for opened in open_:
            if opened[0] <= score <= opened[1] and opened[4] < n:
                opened[4] += 1
                yield anchor, opened[2], opened[4], other, opened[3], score


FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine_hard_negatives(
    rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, span: Span = Span()
) -> DataFrame:
    """The first negatives of each window of each anchor's positives; both inputs as usable() gives them."""
    spark = rows.sparkSession
    rows = stored(rows, "vectors")
    total = rows.count()
    if not total:
        return spark.createDataFrame([], FOUND)
    asked = stored(anchors.withColumn("levels", F.lit(None).cast("array<long>")), "anchors")
    shards = max(2 * spark.sparkContext.defaultParallelism, -(-total // SHARD_ROWS))

    def best(shard, scores, anchor, label, levels):
        return shard.positives(scores, anchor, label, positives), True

    def inside(shard, scores, anchor, label, levels):
        return shard.negatives(scores, anchor, label, {span.bounds(p) for p in levels}, negatives), False

    order = F.row_number().over(Window.partitionBy("anchor", "h").orderBy(F.desc("score"), "id"))
    kept = _past_shards(rows, asked, shards, best).withColumn("n", order).where(F.col("n") <= positives).drop("n")
    kept = stored(kept, "positives")

    levels = kept.groupBy("anchor", "h").agg(F.collect_set("score").alias("levels")).withColumnRenamed("anchor", "id")
    rest = _past_shards(rows, asked.drop("levels").join(levels, ["id", "h"]), shards, inside)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        out = []
        for r in emitted(pairs(), span, negatives):
            out.append(r)
            if len(out) == 8192:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    pairs = kept.unionByName(rest)
    by_anchor = pairs.repartition("anchor", "h").sortWithinPartitions("anchor", "h", F.desc("score"), "id", F.desc("positive"))
    return by_anchor.mapInArrow(stream, FOUND)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[c.split()[0] for c in FOUND.split(", ")])


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", label)
    return mine_hard_negatives(rows, rows.where("id % 50 = 0"))


ORACLE = r"""
WITH usable AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    list_dot_product(a.v, b.v)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT * FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
found AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS rank
  FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same
    AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM found WHERE rank <= 3
"""
