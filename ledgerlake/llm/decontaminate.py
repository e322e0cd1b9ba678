"""Benchmark decontamination by greedy string tiling.

Seeds: word windows of MIN_MATCH words that a text shares with a benchmark item, found by
Karp-Rabin hashes and joined on their hash. Seeds on one diagonal that follow each other make a
maximal match. Tiling takes the longest match whose words are free on both sides, marks it, cuts
the others back to their free parts and goes on, so that passages in another order are counted
and no word counts twice. A text is contaminated by an item when the marked words are at least
THRESHOLD of the item.

The texts are read once and only seed hits leave that pass: seeds outside the benchmark are
dropped where they are made, against the sorted seed hashes of a block of items. A benchmark of
more than SEED_LIMIT seeds is taken in blocks, one pass each, so the broadcast keeps a bound.

Defined cases: null and empty texts match nothing; an empty item is never contained; an item of
fewer than MIN_MATCH words must occur as a whole; rows that repeat an id and its text give their
pair once; rows without an id are reported under a null id; items without an id are left out, as no
pair could name them (the pipeline gives them a key first).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import doc_key, ngrams, per_text, stored, within

MIN_MATCH = 5
THRESHOLD = 0.5
SEED_LIMIT = 1 << 21
HITS_A_TASK = 50_000


def item_seeds(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, n_words, k, seed, pos) of every item; k: the seed's words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for item, w in zip(ids, per_text(batch.column(1))):
                k = min(MIN_MATCH, len(w))
                if k and item is not None:
                    seeds = ngrams(w, k)
                    out.append(pd.DataFrame({"item": item, "n_words": len(w), "k": k, "seed": seeds.view(np.int64), "pos": np.arange(len(seeds))}))
            if out:
                yield pa.RecordBatch.from_pandas(pd.concat(out), preserve_index=False)

    rows = benchmark.select(F.col(item_col).cast("long"), F.coalesce(F.col(text_col), F.lit(""))).distinct()
    return rows.mapInArrow(scan, "item long, n_words long, k long, seed long, pos long")


def seed_hits(docs: DataFrame, seeds: DataFrame) -> DataFrame:
    """(k_id, k_text, k, seed, at): the windows of the texts whose hashes are benchmark seeds."""
    listed = {}
    for r in seeds.select("k", "seed").distinct().collect():  # at most SEED_LIMIT, see blocks()
        listed.setdefault(r.k, []).append(r.seed)
    listed = {k: np.sort(np.array(v, np.int64).view(np.uint64)) for k, v in listed.items()}
    known = docs.sparkSession.sparkContext.broadcast(listed)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, w in enumerate(per_text(batch.column(2))):
                for k, values in known.value.items():
                    made = ngrams(w, k)
                    at = np.flatnonzero(within(made, values))
                    if len(at):
                        out.append((np.full(len(at), row), np.full(len(at), k), made[at].view(np.int64), at))
            if out:
                row, k, seed, at = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(k), pa.array(seed), pa.array(at)],
                    names=["k_id", "k_text", "k", "seed", "at"],
                )

    return docs.mapInArrow(scan, "k_id long, k_text long, k long, seed long, at long")


def tiles(matches: list[tuple[int, int, int]], shortest: int) -> list[tuple[int, int, int]]:
    """Greedy tiling of maximal matches (text position, item position, words); ties to the left."""
    heap = [(-n, at, pos) for at, pos, n in matches]
    heapq.heapify(heap)
    used_text: set[int] = set()
    used_item: set[int] = set()
    taken = []
    while heap:
        n, at, pos = heapq.heappop(heap)
        free = [i for i in range(-n) if at + i not in used_text and pos + i not in used_item]
        if len(free) == -n:
            taken.append((at, pos, -n))
            used_text.update(range(at, at - n))
            used_item.update(range(pos, pos - n))
            continue
        start = 0
        for i in range(1, len(free) + 1):
            if i == len(free) or free[i] != free[i - 1] + 1:
                if i - start >= shortest:
                    heapq.heappush(heap, (start - i, at + free[start], pos + free[start]))
                start = i
    return taken


def _tile(group: pd.DataFrame) -> pd.DataFrame:
    first = group.iloc[0]
    k = int(first.k)
    taken = tiles(list(zip(group["at"], group["pos"], group["words"])), k)
    marked = sum(n for _, _, n in taken)
    return pd.DataFrame(
        {
            "k_id": [first.k_id], "k_text": [first.k_text], "item_id": [first["item"]], "n_tiles": [len(taken)],
            "n_marked": [marked], "coverage": [marked / first.n_words],
            "tiles": [sorted([int(a), int(p), int(n)] for a, p, n in taken)],
        }
    )


def blocks(seeds: DataFrame) -> list[DataFrame]:
    """The seeds in as many blocks of whole items as keep each under SEED_LIMIT on average."""
    n = max(1, -(-2 * seeds.count() // SEED_LIMIT))
    return [seeds.where(F.pmod(F.xxhash64("item"), F.lit(n)) == i) for i in range(n)] if n > 1 else [seeds]


def contaminated(
    documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", threshold: float = THRESHOLD,
) -> DataFrame:
    """(k_id, k_text, item_id, n_tiles, n_marked, coverage, tiles) of every contaminated pair.

    k_id and k_text are the document's key (common.doc_key); tiles: (text word, item word, words).
    """
    key_id, key_text = doc_key(id_col, text_col)
    docs = documents.select(key_id.cast("long").alias("k_id"), key_text, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    seeds = stored(item_seeds(benchmark, item_col, "text"), "seeds")
    hits = None
    for block in blocks(seeds):
        part = seed_hits(docs, block).join(block, ["k", "seed"])
        hits = part if hits is None else hits.unionByName(part)
    hits = stored(hits.distinct(), "hits")
    # Tiling costs far more than the bytes of its rows tell, so the number of tasks follows the rows.
    tasks = max(4 * docs.sparkSession.sparkContext.defaultParallelism, -(-hits.count() // HITS_A_TASK))
    hits = hits.withColumn("diagonal", F.col("at") - F.col("pos")).repartition(tasks, "k_id", "k_text", "item")
    # Seeds that follow each other on a diagonal have one value of at - (rank on the diagonal).
    key = ["k_id", "k_text", "item", "n_words", "k", "diagonal"]
    rank = F.row_number().over(Window.partitionBy(*key).orderBy("at"))
    matches = (
        hits.withColumn("run", F.col("at") - rank).groupBy(*key, "run")
        .agg(F.min("at").alias("at"), F.min("pos").alias("pos"), (F.count("*") + F.col("k") - 1).alias("words"))
    )
    # No tiling can pass if even all matched words together fall short.
    enough = F.sum("words").over(Window.partitionBy("k_id", "k_text", "item")) >= threshold * F.col("n_words")
    matches = matches.withColumn("enough", enough).where("enough")
    out = matches.groupBy("k_id", "k_text", "item").applyInPandas(
        _tile, "k_id long, k_text long, item_id long, n_tiles long, n_marked long, coverage double, tiles array<array<long>>"
    )
    return out.where(F.col("coverage") >= threshold)


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    out = contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select(F.col("k_id").alias("doc_id"), "item_id", "n_tiles", "n_marked", "coverage")
