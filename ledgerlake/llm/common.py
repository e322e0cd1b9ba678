"""Shared helpers: scratch tables, hashed words of Arrow text columns, components.

Conventions of every operator here: columns are picked by name at the start, so further columns
of the input never clash; a null text counts as an empty one; a text is always read whole.
"""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import scratch_dir

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
PIECE_BYTES = 1 << 18  # text hashed at once by one task; bounds the numpy temporaries
MASK = 0xFFFFFFFFFFFFFFFF


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as the session's settings name it: the same folder for every task."""
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = made.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(made).toString()
    return whole.replace("file:/", "file:///", 1) if whole.startswith("file:/") and not whole.startswith("file://") else whole


def bounded_memory(spark: SparkSession, batch: int = 8 << 20, row_group: int = 32 << 20) -> None:
    """Let tasks hand texts to Python in batches of at most about batch bytes, and write Parquet row groups
    of row_group bytes, of which each writing task holds one. Results do not depend on either."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch))
    spark.conf.set("parquet.block.size", str(row_group))


def _trim():
    """The C library's call that gives freed memory back to the system; nothing where there is none."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return lambda _: 0


def released(value):
    """The value, after memory that is no longer used went back; called between pieces of a batch."""
    pa.default_memory_pool().release_unused()
    _trim()(0)
    return value


def kept(name: str, make):
    """One object for each name and Python worker; it outlives the task that made it.

    A worker serves the stages of a session one after the other: making an object gives back what earlier
    ones left, the powers of the word hashes and freed memory; making those powers gives back the objects.
    """
    held = _held()
    if name not in held:
        _POWERS.clear()
        _give_back()
        held[name] = released(make())
    return held[name]


def _held() -> dict:
    return sys.modules.setdefault("ledgerlake_llm_kept", types.ModuleType("ledgerlake_llm_kept")).__dict__


def _give_back() -> None:
    held = _held()
    for name in [k for k in held if k.split("-")[0] in ("codec", "ranks")]:
        del held[name]
    gc.collect()
    released(None)


def small(df: DataFrame, rows: int, row_bytes: int, limit: int = 32 << 20) -> DataFrame:
    """Hint a broadcast only where the counted rows times their width stay under limit bytes.

    Beyond it the plan is the ordinary shuffle join, which gives the same rows.
    """
    return F.broadcast(df) if rows * row_bytes <= limit else df


def doc_key(doc_id: str, text: str) -> list:
    """Key of a row by content: rows repeated under one id agree in it, different texts do not."""
    return [F.col(doc_id).alias("k_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("k_text")]


def _lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = _lower_table()
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64, for i < n."""
    if not _POWERS or len(_POWERS[0]) < n:
        if not _POWERS:
            _give_back()
        size = max(n, 1 << 16)
        up = np.full(size, BASE, dtype=np.uint64)
        up[0] = 1
        down = np.full(size, np.uint64(pow(int(BASE), -1, 1 << 64)), dtype=np.uint64)
        down[0] = 1
        _POWERS[:] = [np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)]
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and its n + 1 offsets into them; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def _piece(
    raw: np.ndarray, cuts: np.ndarray, fold: np.ndarray, gaps: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of one piece; cuts: starts of texts, which part words."""
    text = fold[raw]
    space = gaps[raw]
    opens = ~space
    before = np.empty_like(space)
    before[:1] = True
    before[1:] = space[:-1]
    before[cuts] = True
    starts = np.flatnonzero(opens & before)
    after = np.empty_like(space)
    after[-1:] = True
    after[:-1] = space[1:]
    after[cuts[cuts > 0] - 1] = True
    ends = np.flatnonzero(opens & after) + 1
    up, down = _powers(len(text))
    total = np.zeros(len(text) + 1, dtype=np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts]), starts, ends


def words(
    column: pa.Array, fold: np.ndarray = LOWER, gaps: np.ndarray = IS_SPACE, sized: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all folded words, and the n + 1 offsets of the texts into them.

    Words are runs of bytes outside gaps; by default gaps are space, tab, LF, VT, FF and CR, and
    folding lower-cases A-Z only. Texts are hashed whole, in pieces of a few MB cut at gaps. With
    sized, the lowest six bits of a hash are the word's length in bytes (63 at most).
    """
    raw, at = utf8(column)
    hashes, firsts = [], []
    done = 0
    while done < len(raw):
        end = min(len(raw), done + PIECE_BYTES)
        if end < len(raw):
            cut = at[np.searchsorted(at, end, "right") - 1]  # a text's start, if there is one in reach
            if cut <= done:
                found = np.flatnonzero(gaps[raw[done:end]])
                if len(found):
                    cut = done + found[-1] + 1
                else:  # one word longer than a piece
                    stop = int(at[np.searchsorted(at, done, "right")])
                    rest = np.flatnonzero(gaps[raw[end:stop]])
                    cut = end + rest[0] + 1 if len(rest) else stop
            end = int(cut)
        inside = at[(at >= done) & (at < end)] - done
        found, starts, ends = _piece(raw[done:end], inside, fold, gaps)
        if sized:
            found = found & np.uint64(MASK - 63) | np.minimum(ends - starts, 63).astype(np.uint64)
        hashes.append(found)
        firsts.append(starts + done)
        done = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(firsts), at)


def hashes_of(listed: list[str], **how) -> np.ndarray:
    """Sorted hashes of single words, as words() gives them."""
    return np.unique(words(pa.array(listed), **how)[0])


def within(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Which values are in a sorted list."""
    if not len(listed):
        return np.zeros(len(values), bool)
    return listed[np.minimum(np.searchsorted(listed, values), len(listed) - 1)] == values


def pieces(column: pa.Array, size: int = PIECE_BYTES) -> Iterator[pa.Array]:
    """Runs of whole texts of about size bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, at = utf8(column)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(at, at[a] + size, "right")) - 1)
        yield column.slice(a, b - a)
        a = b


def ngrams(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word windows of one text's words."""
    if len(word_hashes) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(word_hashes) - n + 1, dtype=np.uint64)
    for i in range(n):
        total = total * BASE + word_hashes[i : i + len(total)]
    return mix(total)


def shingle_set(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct shingles of sized words, longest first; a shorter text is one shingle.

    The upper six bits fall with the shingle's length. Long shingles are rare ones, so the first
    elements of the sets of unrelated texts hardly ever meet.
    """
    k = min(n, len(word_hashes))
    if k == 0:
        return np.zeros(0, np.uint64)
    total = np.concatenate([[0], np.cumsum((word_hashes & np.uint64(63)).astype(np.int64))])
    size = np.minimum((total[k:] - total[:-k]) >> 2, 63).astype(np.uint64)
    made = ngrams(word_hashes, k) + np.uint64(k)
    return np.unique((np.uint64(63) - size) << np.uint64(58) | made >> np.uint64(6))


def per_text(column: pa.Array, sized: bool = False) -> Iterator[np.ndarray]:
    """The word hashes of each text, hashed piece by piece."""
    for piece in pieces(column):
        found, at = words(piece, sized=sized)
        for a, b in zip(at[:-1], at[1:]):
            yield found[a:b]


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of a partition that is sorted by keys, whole even where batches part them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            own = tuple(c[a] for c in columns)
            if held and own != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = own
    if held:
        yield pa.Table.from_batches(held)


def components(nodes: DataFrame, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, root): root is the smallest id reachable over edges (a, b).

    Each round lowers the root of both ends' roots to the smaller one and then follows roots
    one step further; every round is a written table. Nothing passes through the driver but a
    count of changes. Following roots doubles the way of a change with each round, so 60 rounds are
    beyond any number of ids; if they do not settle it is an error, never a partial result.
    """
    edges = stored(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges"
    )
    roots = stored(
        edges.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("root", F.col("id")), "roots"
    )
    for _ in range(rounds):
        at_a = roots.select(F.col("id").alias("a"), F.col("root").alias("ra"))
        at_b = roots.select(F.col("id").alias("b"), F.col("root").alias("rb"))
        hooks = (
            edges.join(at_a, "a").join(at_b, "b").where("ra != rb")
            .select(F.greatest("ra", "rb").alias("root"), F.least("ra", "rb").alias("low"))
            .groupBy("root").agg(F.min("low").alias("low"))
        )
        hooks = stored(hooks, "hooks")
        if hooks.isEmpty():
            break
        lowered = roots.join(hooks, "root", "left").select("id", F.coalesce("low", "root").alias("root"))
        lowered = stored(lowered, "roots")
        for _ in range(2):
            up = lowered.select(F.col("id").alias("root"), F.col("root").alias("up"))
            lowered = lowered.join(up, "root").select("id", F.col("up").alias("root"))
        roots = stored(lowered, "roots")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return nodes.join(roots, "id", "left").select("id", F.coalesce("root", "id").alias("root"))
