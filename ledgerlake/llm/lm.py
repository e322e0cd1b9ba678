"""Language-model scores by deleted interpolation.

P(w | v) = a c(v, w) / c(v) + b c(w) / N + c / (V + 1); the weights a, b, c depend on the bucket of
log2 c(v). They are learned by expectation-maximisation on deleted counts: every training token is
scored by the counts without itself. All pairs are counted, however rare their words; a pair is known
by a 64-bit hash of both words, so no vocabulary is gathered or broadcast.

Texts are read once, into chunks: token numbers within a chunk and the chunk's distinct words. What
is shuffled are the sorted distinct words (and pairs) of a chunk with their counts, cut into
parts; a part sums them up and hands each chunk its totals back. A frequent word therefore travels
once a chunk, and no part or chunk grows with the corpus.

Defined cases: a null or empty text is its end token only; rows without an id are training rows;
rows that repeat an id are scored each and counted each; without training rows the probability is
that of the uniform distribution over one unknown word (score 0).
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import BASE, mix, pieces, runs, stored, words

CHUNK_BYTES = 8 << 20
PART_ENTRIES = 1 << 20  # distinct entries of chunks that one part sums up, about; of pairs at most four times as many
END = np.uint64(0x454E44)
START = np.uint64(0x5354415254)  # stands before a text's first word
BUCKETS = 48
STEPS = 4  # histogram steps for each doubling of a probability
NOTHING = -100_000
ROUNDS = 60
TOTALS = -1  # in the place of a chunk: a part's own totals

CHUNKS = "chunk long, ids array<long>, at binary, held binary, tokens binary, vocabulary binary, train binary, n_train long, n_tokens long"
SLICES = "part int, chunk long, entries binary, counts binary"
SUMS = "chunk long, part int, counts binary, n_distinct long"


def squeeze(values: np.ndarray) -> bytes:
    """Compressed little-endian bytes, equal places together."""
    return zlib.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes(), 1)


def expand(data: bytes, kind=np.uint64) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(size, -1).T).view(kind).ravel()


def ascending(values: np.ndarray) -> bytes:
    return squeeze(np.diff(values, prepend=np.uint64(0)))


def climb(data: bytes) -> np.ndarray:
    return np.cumsum(expand(data), dtype=np.uint64)


def read_chunks(docs: DataFrame) -> DataFrame:
    """Chunks of tokenised texts; docs: id, held, text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for piece in pieces(batch.column(2), CHUNK_BYTES):
                ids = batch.column(0).slice(first, len(piece)).cast(pa.int64()).to_pylist()
                held = batch.column(1).slice(first, len(piece)).to_numpy(zero_copy_only=False).astype(bool)
                first += len(piece)
                found, at = words(piece)
                at = at.astype(np.int64)
                tokens = np.insert(found, at[1:], END)
                at = at + np.arange(len(at))
                distinct, tokens, times = np.unique(tokens, return_inverse=True, return_counts=True)
                order = np.argsort(-times, kind="stable")
                rank = np.empty(len(order), np.uint32)
                rank[order] = np.arange(len(order), dtype=np.uint32)
                tokens = rank[tokens]
                train = np.bincount(tokens[np.repeat(~held, np.diff(at))], minlength=len(order)).astype(np.uint64)
                row = {
                    "chunk": [uuid.uuid4().int >> 66], "ids": [ids], "at": [squeeze(at)], "held": [held.tobytes()],
                    "tokens": [squeeze(tokens)], "vocabulary": [distinct[order].tobytes()], "train": [squeeze(train)],
                    "n_train": [int(train.sum())], "n_tokens": [len(tokens)],
                }
                yield pa.RecordBatch.from_pydict(row, schema=CHUNK_SCHEMA)

    return docs.mapInArrow(scan, CHUNKS)


CHUNK_SCHEMA = pa.schema(
    [("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("at", pa.binary()), ("held", pa.binary()),
     ("tokens", pa.binary()), ("vocabulary", pa.binary()), ("train", pa.binary()), ("n_train", pa.int64()), ("n_tokens", pa.int64())]
)


def part_of(entries: np.ndarray, parts: int) -> np.ndarray:
    """Ranges of the hashes, which are spread evenly; entries of a part are close to each other, so they squeeze well."""
    return ((entries >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def dealt(chunk: int, entries: np.ndarray, counts: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """A chunk's sorted distinct entries by part; parts are ranges, so each is one slice."""
    part = part_of(entries, parts)
    cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1), len(part)] if len(part) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        own, p = slice(a, b), part[a]
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([p], pa.int32()), "chunk": [chunk], "entries": [ascending(entries[own])], "counts": [squeeze(counts[own])]}
        )


def sums(slices: DataFrame, parts: int) -> DataFrame:
    """Totals over all chunks, handed back by chunk and part, and each part's number of entries."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["part"]):
            part = group["part"][0].as_py()
            own = [climb(e) for e in group["entries"].to_pylist()]
            distinct, where = np.unique(np.concatenate(own), return_inverse=True)
            counts = np.concatenate([expand(c) for c in group["counts"].to_pylist()])
            total = np.bincount(where, weights=counts, minlength=len(distinct)).astype(np.uint64)
            at = 0
            for chunk, entries in zip(group["chunk"].to_pylist(), own):
                back = total[where[at : at + len(entries)]]
                at += len(entries)
                yield pa.RecordBatch.from_pylist([{"chunk": chunk, "part": part, "counts": squeeze(back), "n_distinct": 0}], schema=SUM_SCHEMA)
            row = {"chunk": TOTALS, "part": part, "counts": None, "n_distinct": int((total > 0).sum())}
            yield pa.RecordBatch.from_pylist([row], schema=SUM_SCHEMA)

    return slices.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(add, SUMS)


SUM_SCHEMA = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("counts", pa.binary()), ("n_distinct", pa.int64())])


def by_chunk(totals: DataFrame, name: str) -> DataFrame:
    rows = totals.where(F.col("chunk") != TOTALS).groupBy("chunk")
    return rows.agg(F.collect_list(F.struct("part", "counts")).alias(name))


def handed_back(parts: list[dict], entries: np.ndarray, n: int) -> np.ndarray:
    """Totals in the order of the chunk's sorted entries."""
    out, part = np.zeros(len(entries), np.float64), part_of(entries, n)
    starts = np.searchsorted(part, [p["part"] for p in parts])
    for a, p in zip(starts, parts):
        found = expand(p["counts"])
        out[a : a + len(found)] = found
    return out


class Chunk:
    def __init__(self, row: dict):
        self.at = expand(row["at"], np.int64)
        self.held = np.frombuffer(row["held"], bool)
        self.tokens = expand(row["tokens"], np.uint32)
        self.vocabulary = np.frombuffer(row["vocabulary"], np.uint64)
        self.trains = np.repeat(~self.held, np.diff(self.at))
        self.first = np.zeros(len(self.tokens), bool)
        self.first[self.at[:-1]] = True

    def pairs(self) -> np.ndarray:
        """Hashes of every token with the one before it."""
        word = self.vocabulary[self.tokens]
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[self.first] = START
        return mix(before * BASE + word)


@dataclass
class Model:
    n: int  # training tokens
    v: int  # distinct ones
    texts: int  # training texts
    parts: tuple[int, int]
    weights: np.ndarray | None = None

    def counts(self, chunk: Chunk, row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """c(v, w), c(v) and c(w) of every token; v: the word before."""
        order = np.argsort(chunk.vocabulary)
        single = np.zeros(len(order))
        single[order] = handed_back(row["singles"], chunk.vocabulary[order], self.parts[0])
        word = single[chunk.tokens]
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[chunk.first] = self.texts
        distinct, at = np.unique(chunk.pairs(), return_inverse=True)
        return handed_back(row["pairs"], distinct, self.parts[1])[at], before, word

    @staticmethod
    def bucket(before: np.ndarray) -> np.ndarray:
        return np.where(before > 0, np.minimum(np.log2(np.maximum(before, 1)).astype(np.int64) + 1, BUCKETS - 1), 0)


def deleted_counts(joined: DataFrame, fitted: Broadcast) -> DataFrame:
    """(cell, n): histogram of the training tokens' probabilities without themselves.

    A cell holds the bucket and the steps of both ratios to the uniform probability, so there is a
    fixed number of cells, however long the corpus is.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**fitted.value)
        for batch in batches:
            for row in rows_of(batch):
                chunk = Chunk(row)
                pair, before, word = (c[chunk.trains] for c in model.counts(chunk, row))
                with np.errstate(divide="ignore", invalid="ignore"):
                    two = np.log2(np.maximum(pair - 1, 0) / np.maximum(before - 1, 1) * (model.v + 1))
                    one = np.log2((word - 1) / max(model.n - 1, 1) * (model.v + 1))
                two, one = (np.where(np.isfinite(x), np.round(np.nan_to_num(x, neginf=0) * STEPS), NOTHING).astype(np.int64) for x in (two, one))
                cells, n = np.unique((Model.bucket(before) << 40) + ((two + 200_000) << 20) + (one + 200_000), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(n)], names=["cell", "n"])

    return joined.mapInArrow(scan, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def mixture(cells: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights (pair, word, uniform) of each bucket by expectation-maximisation."""
    weights = np.tile([0.0, 0.0, 1.0], (BUCKETS, 1))
    bucket, steps = cells >> 40, np.stack([(cells >> 20) % (1 << 20), cells % (1 << 20)], axis=1) - 200_000
    ratio = np.where(steps == NOTHING, 0.0, 2.0 ** (np.where(steps == NOTHING, 0, steps) / STEPS))
    ratio = np.concatenate([ratio, np.ones((len(cells), 1))], axis=1)
    for b in np.unique(bucket):
        own, times = ratio[bucket == b], n[bucket == b][:, None]
        w = np.full(3, 1 / 3)
        for _ in range(ROUNDS):
            share = own * w
            w = (share / share.sum(axis=1, keepdims=True) * times).sum(axis=0) / times.sum()
        w[2] = max(w[2], 1e-6)  # an unknown word stays possible
        weights[b] = w / w.sum()
    if len(cells):
        weights[~np.isin(np.arange(BUCKETS), bucket)] = weights[np.unique(bucket)[0]] * [0, 1, 1] + [0, 0, 1e-6]
        weights /= weights.sum(axis=1, keepdims=True)
    return weights


def scored(joined: DataFrame, fitted: Broadcast) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**fitted.value)
        for batch in batches:
            for row in rows_of(batch):
                chunk = Chunk(row)
                pair, before, word = model.counts(chunk, row)
                w = model.weights[Model.bucket(before)]
                p = w[:, 0] * pair / np.maximum(before, 1) + w[:, 1] * word / max(model.n, 1) + w[:, 2] / (model.v + 1)
                base = np.log10((word + 1) / (model.n + model.v + 1))
                at = chunk.at[:-1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["ids"], pa.int64()), pa.array(chunk.held), pa.array(np.diff(chunk.at)),
                        pa.array(np.add.reduceat((word > 0).astype(np.int64), at)), pa.array(np.full(len(at), model.n)),
                        pa.array(np.add.reduceat(base, at)), pa.array(np.add.reduceat(np.log10(p), at)),
                    ],
                    names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return joined.mapInArrow(scan, "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_texts(documents: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row; held rows are not learned from."""
    docs = documents.select(F.col(id_col).alias("id"), F.coalesce(held, F.lit(False)).alias("held"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chunks = stored(read_chunks(docs), "chunks")
    seen = chunks.agg(
        F.coalesce(F.sum("n_train"), F.lit(0)).alias("n"), F.sum(F.octet_length("vocabulary") / 8).alias("entries"),
        F.sum("n_tokens").alias("tokens"),
    ).first()
    if seen.tokens is None:
        return documents.sparkSession.createDataFrame([], "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    parts = max(1, int(seen.entries) // PART_ENTRIES)

    def singles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                vocabulary = np.frombuffer(row["vocabulary"], np.uint64)
                order = np.argsort(vocabulary)
                yield from dealt(row["chunk"], vocabulary[order], expand(row["train"])[order], parts)

    single = stored(sums(chunks.select("chunk", "vocabulary", "train").mapInArrow(singles, SLICES), parts), "singles")
    distinct = single.agg(F.sum("n_distinct")).first()[0]
    texts = docs.where("not held").count()
    pair_parts = max(1, int(seen.tokens) // (4 * PART_ENTRIES))
    model = Model(int(seen.n), int(distinct), texts, (parts, pair_parts))
    shared = documents.sparkSession.sparkContext.broadcast(vars(model))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                chunk = Chunk(row)
                entries, at = np.unique(chunk.pairs(), return_inverse=True)
                counts = np.bincount(at, weights=chunk.trains, minlength=len(entries)).astype(np.uint64)
                yield from dealt(row["chunk"], entries, counts, pair_parts)

    needed = chunks.select("chunk", "at", "held", "tokens", "vocabulary")
    double = stored(sums(needed.mapInArrow(pairs, SLICES), pair_parts), "pairs")
    joined = chunks.drop("train", "n_train", "n_tokens").join(by_chunk(single, "singles"), "chunk").join(by_chunk(double, "pairs"), "chunk")
    cells = deleted_counts(joined, shared).collect()
    model.weights = mixture(np.array([r.cell for r in cells], np.int64), np.array([r.n for r in cells], np.float64))
    return scored(joined, documents.sparkSession.sparkContext.broadcast(vars(model)))


def op6_lm_scores(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return score_texts(docs, held).withColumnRenamed("id", "doc_id")
