"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling.

Two words are near when one inserted, deleted or replaced code point turns one into the other. With
m the longer length, that is: common prefix plus common suffix reach m - 1. Tiles are pairs of blocks
of words as padded code-point matrices; one pass over the columns from the left gives the common
prefixes of all pairs, one from the right the common suffixes.

Which block pairs are compared: near words share a prefix of half the needed length or a suffix of
the other half, so words are dealt into buckets (m, prefix length a, suffix length b, those letters).
A bucket of more than 16 words that holds over BUCKET_CELLS code points is parted again by the same argument on what
lies between prefix and suffix, until one free place is left; then all of its words are near each
other and there are at most as many as letters. So no bucket grows with the data and no pair is
lost. A pair is counted in one bucket only: each takes prefixes shorter than its limit.

A word's form is its near word of largest count, if that is at least RATIO times the word's own. Forms
are followed to the last one by doubling: counts grow RATIO-fold at each step, so a chain is short.

Defined cases: null and empty texts hold no words; rows count as often as they occur, repeated
rows as well; ties go to the smallest word in code-point order; empty tables give an empty result.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import small, stored

LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
BUCKET_CELLS = 1 << 14
BLOCK_CELLS = 1 << 12  # code points of a block; a tile compares two
STRIP_CELLS = 1 << 16
CHUNK_ROWS = 4_096
TASK_ROWS = 50_000

KEY = ["m", "a", "b", "limit", "h"]


def letter_runs(text: Column, least: int = MIN_LENGTH) -> Column:
    """The maximal runs of at least `least` letters; a greedy match of that many never stops inside a run."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"([{LETTERS}]{{{least},}})"), F.lit(1))


def lowered(word: Column) -> Column:
    return F.when(word.rlike("[A-Z]"), F.translate(word, string.ascii_uppercase, string.ascii_lowercase)).otherwise(word)


def without(word: Column, at: Column) -> Column:
    """The word without the code point at a place, from 0."""
    return F.concat(F.substring(word, F.lit(1), at.cast("int")), F.substring(word, (at + 2).cast("int"), F.length(word)))


def counted(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    long = words.where(F.length("word") >= min_length)
    return long.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _parted(entries: DataFrame) -> DataFrame:
    """Every row once for a longer prefix and once for a longer suffix of its bucket.

    Of the m - 1 shared letters a and b are known. Of the rest either the first half follows the
    prefix, or the prefix ends before that and all but this half stands before the end.
    """
    half = F.ceil((F.col("m") - 1 - F.col("a") - F.col("b")) / 2).cast("int")
    parts = F.array(
        F.struct((F.col("a") + half).alias("a"), F.col("b").alias("b"), F.col("limit").alias("limit")),
        F.struct(F.col("a").alias("a"), (F.col("m") - F.col("a") - half).cast("int").alias("b"), (F.col("a") + half).alias("limit")),
    )
    out = entries.select("word", "n", "m", F.explode(parts).alias("p")).select("word", "n", "m", "p.a", "p.b", "p.limit")
    ends = F.substring("word", F.length("word") - F.col("b") + 1, F.col("b"))
    return out.withColumn("h", F.xxhash64(F.substring("word", F.lit(1), F.col("a")), ends))


def buckets(words: DataFrame, cells: int = BUCKET_CELLS) -> DataFrame:
    """(word, n, m, a, b, limit, h): words in buckets of a bounded size; any near pair meets in one.

    A word of length l is in the pairs whose longer word has l or l + 1 letters.
    """
    size = F.length("word")
    start = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("m"))
    start = start.withColumns({"a": F.lit(0), "b": F.lit(0), "limit": F.col("m"), "h": F.lit(0).cast("long")})
    entries = _parted(start)
    done = None
    while True:
        entries = stored(entries, "buckets")
        counts = entries.groupBy(*KEY).agg(F.count("*").alias("size"))
        alone = F.col("size") < 2  # nothing to compare with
        crowded = (F.col("size") > 16) & (F.col("size") * F.col("m") > cells) & (F.col("m") - 1 - F.col("a") - F.col("b") > 0)
        sized = stored(counts.where(~alone).withColumn("crowded", crowded), "bucket-sizes")
        n = {r.crowded: r["count"] for r in sized.groupBy("crowded").count().collect()}
        ready = entries.join(small(sized.where("not crowded").select(*KEY), n.get(False, 0), 96), KEY, "left_semi")
        done = ready if done is None else done.unionByName(ready)
        if not n.get(True):
            return done
        entries = _parted(entries.join(small(sized.where("crowded").select(*KEY), n[True], 96), KEY, "left_semi"))


def matrix(words: list[str], m: int) -> np.ndarray:
    """Words of at most m code points as rows, padded with zeros at the right."""
    return np.array(words, dtype=f"<U{m}").view(np.uint32).reshape(len(words), m)


def _shared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Lengths of the common starts of all pairs of rows."""
    out = np.zeros((len(left), len(right)), np.int32)
    going = np.ones(out.shape, bool)
    strip = max(1, STRIP_CELLS // out.size)  # columns at once
    for c in range(0, left.shape[1], strip):
        same = left[:, None, c : c + strip] == right[None, :, c : c + strip]
        if strip == 1:
            going &= same[:, :, 0]
            out += going
        else:
            length = np.where(same.all(axis=2), same.shape[2], same.argmin(axis=2))
            out += np.where(going, length, 0).astype(np.int32)
            going &= length == same.shape[2]
        if not going.any():
            break
    return out


def _reversed(words: list[str], m: int) -> np.ndarray:
    return matrix([w[::-1] for w in words], m)


class Block:
    """Consecutive rows of one m, as matrices read from the left and from the right."""

    def __init__(self, words: list[str], m: int, keys: np.ndarray, rest: np.ndarray, at: int):
        self.m, self.at, self.keys, self.rest = m, at, keys, rest
        self.size = np.array([len(w) for w in words])
        self.left, self.right = matrix(words, m), _reversed(words, m)

    def near(self, other: Block) -> tuple[np.ndarray, np.ndarray]:
        """Places of near pairs that this block and a later one (or itself) share a bucket for."""
        prefix, suffix = _shared(self.left, other.left), _shared(self.right, other.right)
        a, b, limit = self.rest
        longest = np.maximum(self.size[:, None], other.size) == self.m
        hit = (self.keys[:, None] == other.keys) & longest & (prefix + suffix >= self.m - 1)
        hit &= (prefix >= a[:, None]) & (suffix >= b[:, None]) & (prefix < limit[:, None])
        if self is other:
            hit &= np.triu(np.ones(hit.shape, bool), 1)
        i, j = np.nonzero(hit)
        return i + self.at, j + other.at


def near_in(words: list[str], m: np.ndarray, keys: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs among rows that are sorted by m and bucket; keys numbers the buckets upwards."""
    cuts, blocks = [0], []
    while cuts[-1] < len(words):
        start = cuts[-1]
        same = int(np.searchsorted(m, m[start], "right"))
        cuts.append(min(same, start + max(1, BLOCK_CELLS // int(m[start]))))
    found = []
    for start, end in zip(cuts[:-1], cuts[1:]):
        block = Block(words[start:end], int(m[start]), keys[start:end], rest[:, start:end], start)
        blocks = [x for x in blocks if x.keys[-1] == block.keys[0]]  # earlier blocks of a bucket that goes on
        for earlier in [*blocks, block]:
            found.append(earlier.near(block))
        blocks.append(block)
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int))


def near_words(words: DataFrame, cells: int = BUCKET_CELLS) -> DataFrame:
    """(word, n, other, other_n): every ordered pair of near words, once; words: distinct word and n."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compared(table: pa.Table) -> pa.RecordBatch:
            columns = [np.asarray(table[c]) for c in KEY]
            new = np.zeros(table.num_rows, bool)
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            listed, counts = table["word"].to_pylist(), np.asarray(table["n"])
            i, j = near_in(listed, columns[0], np.cumsum(new), np.stack(columns[1:4]))
            i, j = np.concatenate([i, j]), np.concatenate([j, i])
            w = table["word"].combine_chunks()
            return pa.RecordBatch.from_arrays(
                [w.take(pa.array(i)), pa.array(counts[i]), w.take(pa.array(j)), pa.array(counts[j])], names=["word", "n", "other", "other_n"]
            )

        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < CHUNK_ROWS:
                continue
            table = pa.Table.from_batches(held)
            # The last bucket may go on in the next batch.
            columns = [np.asarray(table[c]) for c in KEY]
            other = np.zeros(table.num_rows, bool)
            for c in columns:
                other |= c != c[-1]
            end = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
            if end:
                yield compared(table.slice(0, end))
            held = table.slice(end).to_batches()
        if held and sum(b.num_rows for b in held):
            yield compared(pa.Table.from_batches(held))

    dealt = buckets(words, cells).select("word", "n", *KEY)
    # A row costs far more here than its bytes tell, so the number of tasks follows the rows: about four a word.
    tasks = max(2 * words.sparkSession.sparkContext.defaultParallelism, -(-4 * words.count() // TASK_ROWS))
    dealt = dealt.repartition(tasks, *KEY).sortWithinPartitions(*KEY)
    return dealt.mapInArrow(scan, "word string, n long, other string, other_n long")


def spelling_variants(words: DataFrame, ratio: int = RATIO, cells: int = BUCKET_CELLS) -> DataFrame:
    """(word, n, form, form_n, n_near, root) of distinct words and their counts."""
    words = stored(words.select("word", "n"), "words")
    near = near_words(words, cells)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other")))
    linked = near.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    strong = -F.col("best.less") >= ratio * F.col("n")
    linked = linked.select("word", "n_near", F.when(strong, F.col("best.other")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n"))
    linked = stored(linked, "forms")
    roots = stored(linked.where("form is not null").select("word", F.col("form").alias("up")), "roots")
    while True:
        # Each step doubles the way; a word without a form ends it.
        above = roots.select(F.col("word").alias("up"), F.col("up").alias("top"))
        stepped = roots.join(above, "up", "left").select("word", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved"))
        stepped = stored(stepped, "roots")
        roots = stepped.select("word", "up")
        if stepped.where("moved").isEmpty():
            break
    out = words.join(linked, "word", "left").join(roots, "word", "left")
    return out.select(
        "word", "form", F.coalesce("up", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )


def misspelt(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 199) -> DataFrame:
    """(word): the words of whole texts, one code point deleted where the checksum of id and word asks for it.

    A missing id counts as an empty one.
    """
    runs = documents.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(letter_runs(F.col(text_col))).alias("run"))
    runs = runs.select("id", lowered(F.col("run")).alias("run"))
    h = F.crc32(F.concat_ws(":", "id", "run"))
    runs = runs.withColumn("h", h)
    cut = without(F.col("run"), F.col("h") % F.length("run"))
    return runs.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    words = misspelt(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return spelling_variants(counted(words))


ORACLE = r"""
WITH RECURSIVE bits AS (
  SELECT i AS byte, 0 AS step, i::UBIGINT AS v FROM range(256) t(i)
  UNION ALL
  SELECT byte, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END FROM bits WHERE step < 8),
crc AS (SELECT list(v ORDER BY byte) AS t FROM bits WHERE step = 8),
runs AS (
  SELECT DISTINCT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
hex AS (SELECT doc_id, run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, n, xor(list_reduce(
      list_prepend(4294967295::UBIGINT, list_transform(range(length(x) // 2), lambda i: ('0x' || x[2 * i + 1 : 2 * i + 2])::UBIGINT)),
      lambda acc, b: xor(acc >> 8, t[(xor(acc & 255, b) + 1)::BIGINT])), 4294967295::UBIGINT) AS h
  FROM hex, crc),
made AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word, n
  FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM made WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
holes AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM holes a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM holes a JOIN words b ON a.rest = b.word),
linked AS (
  SELECT word, any_value(n) AS n, count(*) AS n_near,
    first(other ORDER BY other_n DESC, encode(other)) AS best, max(other_n) AS best_n
  FROM near GROUP BY word),
forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * words.n THEN best END AS form,
    CASE WHEN best_n >= 5 * words.n THEN best_n END AS form_n
  FROM words LEFT JOIN linked ON words.word = linked.word),
steps AS (
  SELECT word, word AS up FROM forms
  UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON s.up = f.word WHERE f.form IS NOT NULL),
roots AS (SELECT s.word, s.up AS root FROM steps s JOIN forms f ON s.up = f.word WHERE f.form IS NULL)
SELECT forms.word, form, root, n, n_near, form_n FROM forms JOIN roots ON forms.word = roots.word
"""
