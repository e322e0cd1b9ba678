"""Token counts by a separator scan over flat, unindexed token files.

A token file is a stream of little-endian unsigned 16- or 32-bit ids in which an end-of-document
id closes every document; nothing else tells where documents are. The scan cuts each file into
blocks of BLOCK_IDS ids wherever they fall, finds the separators of a block with one comparison,
and counts what lies between them. A document that runs across blocks is stitched by a prefix scan
over the blocks' sums: number of separators before a block, and ids since the last of them. Only
these sums (one row a block) are shuffled.

The writer makes such files from texts (tiktoken ranks, a parameter), one or more per task, in the
shared folder, with a manifest of the attempts that counted. It also keeps, apart from the files,
which document stands where, so that counts can be told by doc_id.

Defined cases: null and empty texts have no ids and count 0; ids after the last separator are an
unfinished document, reported with closed = false; an empty file has no documents; rows that
repeat an id are counted each; rows without an id keep a null id.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import kept, qualified, stored
from ledgerlake.session import scratch_dir

BLOCK_IDS = 1 << 20
FILE_IDS = 1 << 25
PLACES = 4_096  # documents of a row that tells which stand in a file
BLOCKS_A_TASK = 64
SEPARATOR = 50_256  # free in the ranks below
# The signs that the tokenizer's pattern takes as white space.
LONG_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")


def ranks(spark, path: str | None = None) -> Broadcast:
    """The ranks file (about 1 MB), read on the driver and broadcast."""
    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _encoder(file: Broadcast) -> tiktoken.Encoding:
    def make() -> tiktoken.Encoding:
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file.value.splitlines() if line)}
        return tiktoken.Encoding("flat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    return kept(f"ranks-{hash(file.value)}", make)


def write(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None, path: str | None = None) -> DataFrame:
    """Write token files; returns (path, n_ids, first, ids): each file's documents in order, in runs of PLACES.

    A file's last row has its length in n_ids, the others have null there.
    """
    target = qualified(documents.sparkSession, folder or scratch_dir(documents.sparkSession, "tokens"))
    file = ranks(documents.sparkSession, path)

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(target)
        fs.create_dir(root, recursive=True)
        encoder, out, name, size, ids, first = _encoder(file), None, "", 0, [], 0

        def places(length: int | None) -> pa.RecordBatch:
            held = {"path": [f"{target}/{name}"], "n_ids": pa.array([length], pa.int64()), "first": [first], "ids": pa.array([ids], pa.list_(pa.int64()))}
            return pa.RecordBatch.from_pydict(held)

        for batch in batches:
            for i, text in zip(batch.column(0).cast(pa.int64()).to_pylist(), batch.column(1)):
                if out is None:
                    name, size, ids, first = f"{uuid.uuid4().hex}.u16", 0, [], 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                found = encoded(encoder, text.as_py() or "")
                out.write(np.array([*found, SEPARATOR], "<u2").tobytes())
                ids.append(i)
                size += len(found) + 1
                if size >= FILE_IDS:
                    out.close()
                    yield places(size)
                    out = None
                elif len(ids) == PLACES:
                    yield places(None)
                    first, ids = first + PLACES, []
        if out is not None:
            out.close()
            yield places(size)

    rows = documents.select(F.col(id_col), F.col(text_col)).mapInArrow(save, "path string, n_ids long, first long, ids array<long>")
    return stored(rows, "token_files")


def encoded(encoder: tiktoken.Encoding, text: str) -> list[int]:
    """The ids of a text. A long run of white space is one pre-token, but for its last sign before a word.

    The library looks such runs up by backtracking and gives up on very long ones, so they are cut
    out here and merged as the pre-tokens they are.
    """
    out, at = [], 0
    for run in LONG_BLANKS.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        out += encoder.encode_ordinary(text[at : run.start()])
        out += encoder._encode_single_piece(text[run.start() : end].encode())
        at = end
    return out + encoder.encode_ordinary(text[at:])


def blocks(files: DataFrame, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(path, block, first, n): the ranges of ids that tasks read; files: path, n_ids."""
    count = F.greatest(F.ceil(F.col("n_ids") / block_ids), F.lit(1)).cast("long")
    rows = files.select("path", "n_ids", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("block"))
    first = F.col("block") * block_ids
    return rows.select("path", "block", first.alias("first"), F.least(F.lit(block_ids), F.col("n_ids") - first).alias("n"))


def scan(files: DataFrame, separator: int = SEPARATOR, width: int = 2, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(path, document, start, n_tokens, closed) of every document in the files (path, n_ids)."""

    home = qualified(files.sparkSession, "/").rstrip("/")  # for paths without a file system

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, block, first, n in zip(*(c.to_pylist() for c in batch.columns)):
                fs, name = pafs.FileSystem.from_uri(path if "://" in path else home + path)
                with fs.open_input_file(name) as f:
                    f.seek(first * width)
                    ids = np.frombuffer(f.read(n * width), f"<u{width}")
                ends = np.flatnonzero(ids == separator)
                yield pa.RecordBatch.from_pydict(
                    {"path": [path], "block": [block], "first": [first], "n": [len(ids)], "ends": pa.array([ends.astype(np.int64)], pa.list_(pa.int64()))},
                )

    ranges = blocks(files, block_ids)
    n = ranges.count()
    spark = files.sparkSession
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-n // BLOCKS_A_TASK))
    found = ranges.repartition(tasks, "path", "block")
    found = stored(found.mapInArrow(search, "path string, block long, first long, n long, ends array<long>"), "separators")

    # Prefix scan over the blocks of a file: separators before, and where the open document began.
    sums = found.select("path", "block", F.size("ends").cast("long").alias("k"), (F.col("first") + F.try_element_at("ends", F.lit(-1))).alias("last"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "path", "block", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("documents"),
        F.coalesce(F.max("last").over(before), F.lit(-1)).alias("open"),
    )
    rows = found.join(sums, ["path", "block"])
    places = F.transform("ends", lambda e: F.col("first") + e)
    starts = F.concat(F.array("open"), F.slice(places, F.lit(1), F.greatest(F.size("ends") - 1, F.lit(0))))
    spans = F.zip_with(starts, places, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    closed = rows.where(F.size("ends") > 0).select("path", "documents", F.posexplode(spans))
    closed = closed.select(
        "path", (F.col("documents") + F.col("pos")).alias("document"), (F.col("col.a") + 1).alias("start"),
        (F.col("col.b") - F.col("col.a") - 1).alias("n_tokens"), F.lit(True).alias("closed"),
    )
    ends = sums_at_end(found)
    tail = ends.where("n_ids > last + 1").select(
        "path", F.col("k").alias("document"), (F.col("last") + 1).alias("start"), (F.col("n_ids") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("closed")
    )
    return closed.unionByName(tail)


def sums_at_end(found: DataFrame) -> DataFrame:
    """(path, k, last, n_ids): separators of each file, the last one's place (-1: none) and the ids read."""
    last = F.col("first") + F.try_element_at("ends", F.lit(-1))
    return found.groupBy("path").agg(
        F.sum(F.size("ends")).cast("long").alias("k"), F.coalesce(F.max(last), F.lit(-1)).alias("last"), F.sum("n").alias("n_ids")
    )


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    files = write(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    counts = scan(files.where("n_ids is not null").select("path", "n_ids"))
    places = files.select("path", "first", F.posexplode("ids").alias("pos", "doc_id"))
    places = places.select("path", (F.col("first") + F.col("pos")).alias("document"), "doc_id")
    out = counts.join(places, ["path", "document"], "left")
    return out.select("doc_id", "n_tokens", "closed")
