"""N-gram Jaccard join over an index of count vectors.

A text's shingles are hashed into GROUPS groups; the counts per group are a point. For two points
the sum of coordinate minima bounds the overlap of the sets from above, and so does the sum of
minima against a node's upper corner for all points below the node. Survivors are verified on the
exact sets.

In so many dimensions the boxes of unrelated texts all overlap, so one tree over the corpus would
compare every point with every leaf. The points are therefore dealt out first: under one order of
all shingles (long ones first, frequent ones last), two sets with a Jaccard of t share a shingle among the first
n - ceil(t n) + 1 of each. Texts that share such a shingle form a bucket; the buckets with one
smallest id form a family, and a packed R-tree is searched in each family. No link is lost by it.

Copies: equal sets collapse to one representative before anything is paired. Near copies are
linked in three rounds, each followed by components: every text with its family's smallest id, then
with the neighbour outside its component that has the best bound, at last all pairs of different
components that pass the bound. Nodes of the tree whose points are all in the query's component are
cut, so pairs within a component are never formed. A large family is cut into blocks of about BLOCK
texts, and each pair of blocks is one small group.

Defined cases: null and empty texts have no shingles and link with nothing; a text under five
words is one shingle; rows without an id link with nothing and have a null component; rows that
repeat an id are one document, linked by whatever links any of its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import bounded_memory, components, per_text, pieces, released, runs, shingle_set, small, stored, within

GROUPS = 256
FINE_GROUPS = 4096  # of sets above FINE_FROM, whose pairs are bounded once more before they are verified
FINE_FROM = 1024
LEAF = 16
BLOCK = 1024
DISTINCT_BYTES = 1 << 20  # text of which equal sets give one row of prefixes
HEAVY_BINS = 1 << 20
LAST_BIN = np.uint64(HEAVY_BINS - 1)
HEAVY_SHARE = 1024  # a shingle in more than 1/1024 of a batch's texts goes last in the order


def read_sets(docs: DataFrame, n: int) -> DataFrame:
    """(id, n_shingles, digest) a row, and of each batch one row with its heavy shingles."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, bins = [], np.zeros(HEAVY_BINS, np.int64)
            for piece in pieces(batch.column(1)):
                own = [shingle_set(w, n) for w in per_text(piece, sized=True)]
                np.add.at(bins, (np.concatenate(own) & LAST_BIN).astype(np.int64), 1)
                sets += released(own)
            rows = len(sets)
            least = max(4, rows // HEAVY_SHARE)
            # Only shingles of a bin that reached the share can be heavy; the others need no sorting.
            full = [s[bins[(s & LAST_BIN).astype(np.int64)] >= least] for s in sets]
            found, times = np.unique(np.concatenate(full), return_counts=True) if rows else (np.zeros(0, np.uint64),) * 2
            heavy = times >= least
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.nulls(rows, pa.list_(pa.int64())),
                    pa.array(np.zeros(rows, bool)),
                ],
                names=["id", "n_shingles", "digest", "heavy", "extra"],
            )
            yield out
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(1, pa.int64()), pa.array([rows], pa.int64()), pa.nulls(1, pa.binary()),
                    pa.array([found[heavy].view(np.int64)], pa.list_(pa.int64())), pa.array([True]),
                ],
                names=["id", "n_shingles", "digest", "heavy", "extra"],
            )

    return docs.mapInArrow(scan, "id long, n_shingles long, digest binary, heavy array<long>, extra boolean")


def read_prefixes(docs: DataFrame, n: int, percent: int, heavy: np.ndarray) -> DataFrame:
    """(node, size, point, fine, keys): once for each distinct set of a piece, under its smallest id."""
    known = docs.sparkSession.sparkContext.broadcast(np.sort(heavy))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for piece in pieces(batch.column(1), DISTINCT_BYTES):
                ids = batch.column(0).slice(at, len(piece)).cast(pa.int64()).to_pylist()
                at += len(piece)
                yield released(_prefixes(ids, [shingle_set(w, n) for w in per_text(piece, sized=True)], percent, known.value))

    return docs.mapInArrow(scan, "node long, size long, point binary, fine binary, keys array<long>")


def _prefixes(ids: list, sets: list[np.ndarray], percent: int, heavy: np.ndarray) -> pa.RecordBatch:
    seen: dict[bytes, int] = {}
    distinct: dict[bytes, np.ndarray] = {}
    for i, s in zip(ids, sets):
        if i is not None and len(s):
            digest = s.tobytes()
            distinct.setdefault(digest, s)
            seen[digest] = min(i, seen.get(digest, i))
    keys, points, fine = [], [], []
    for s in distinct.values():
        late = within(s, heavy)
        order = np.concatenate([s[~late], s[late]])  # s is sorted, so both parts are
        keys.append(order[: len(s) - -(-percent * len(s) // 100) + 1].view(np.int64))
        points.append(pack(grouped(s, GROUPS)))
        fine.append(pack(grouped(s, FINE_GROUPS)) if len(s) > FINE_FROM else None)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(seen.values(), pa.int64()), pa.array([len(s) for s in distinct.values()], pa.int64()),
            pa.array(points, pa.binary()), pa.array(fine, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
        ],
        names=["node", "size", "point", "fine", "keys"],
    )


def grouped(s: np.ndarray, groups: int) -> np.ndarray:
    return np.bincount((s >> np.uint64(20)).astype(np.int64) % groups, minlength=groups)


def pack(counts: np.ndarray) -> bytes:
    return counts.astype(np.uint8 if counts.max(initial=0) < 256 else np.uint32).tobytes()


def unpack(points: list[bytes], groups: int = GROUPS) -> np.ndarray:
    if all(len(p) == groups for p in points):
        return np.frombuffer(b"".join(points), np.uint8).reshape(len(points), groups)
    return np.array([np.frombuffer(p, np.uint8 if len(p) == groups else np.uint32) for p in points], np.uint32)


class Tree:
    """A packed R-tree: points sorted by component and size, LEAF of them below a node."""

    def __init__(self, roots: np.ndarray, sizes: np.ndarray, points: np.ndarray):
        self.order = np.lexsort((points[:, 0], sizes, roots))
        level = [x[self.order] for x in (points, sizes, sizes, roots, roots)]
        self.levels = [level]
        while len(level[0]) > LEAF:
            cuts = np.arange(0, len(level[0]), LEAF)
            most, least = np.maximum.reduceat, np.minimum.reduceat
            level = [f(x, cuts) for f, x in zip((most, least, most, least, most), level)]
            self.levels.append(level)

    def search(self, roots: np.ndarray, sizes: np.ndarray, points: np.ndarray, percent: int):
        """(query, point, bound) of all pairs of two components whose bound allows the Jaccard, level by level."""
        for first in range(0, len(sizes), 512):
            q = np.arange(first, min(first + 512, len(sizes)))
            at = np.arange(len(self.levels[-1][0]))
            q, at = np.repeat(q, len(at)), np.tile(at, len(q))
            for depth in range(len(self.levels) - 1, -1, -1):
                corner, least, most, root_low, root_high = self.levels[depth]
                low = np.maximum(least[at], -(-percent * sizes[q] // 100))
                fits = (low <= most[at]) & (percent * low <= 100 * sizes[q])
                fits &= (root_low[at] != roots[q]) | (root_high[at] != roots[q])
                q, at, low = q[fits], at[fits], low[fits]
                bound = np.zeros(len(q), np.int64)
                for a in range(0, len(q), 1 << 13):
                    part = slice(a, a + (1 << 13))
                    bound[part] = np.minimum(corner[at[part]], points[q[part]]).sum(axis=1, dtype=np.int64)
                fits = (100 + percent) * bound >= percent * (sizes[q] + low)
                q, at, bound = q[fits], at[fits], bound[fits]
                if depth:
                    q, at = np.repeat(q, LEAF), (at[:, None] * LEAF + np.arange(LEAF)).ravel()
                    inside = at < len(self.levels[depth - 1][0])
                    q, at = q[inside], at[inside]
            yield q, self.order[at], bound


def block_pairs(percent: int, best: bool):
    """Pairs (a, b, bound) of different components in a pair of blocks that pass the bound.

    With best, only the one with the highest share for each text (a).
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["low", "i", "j"]):
            left = group["side"].to_numpy() == 0
            node, root, size = (group[c].to_numpy() for c in ("node", "root", "size"))
            if len(node) < 2 or (root == root[0]).all():
                continue
            points = unpack(group["point"].to_pylist())
            right = ~left if (~left).any() else left
            tree = Tree(root[right], size[right], points[right])
            for q, p, bound in tree.search(root[left], size[left], points[left], percent):
                a, b = node[left][q], node[right][p]
                share = bound / (size[left][q] + size[right][p])
                if best:
                    if right is not left:
                        a, b, share = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([share, share])
                    order = np.lexsort((b, -share, a))
                    top = order[np.unique(a[order], return_index=True)[1]]
                    a, b, share = a[top], b[top], share[top]
                elif right is left:
                    a, b, share = a[a < b], b[a < b], share[a < b]
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(share)], names=["a", "b", "share"])

    return join


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose exact sets reach the Jaccard."""

    @F.arrow_udf("boolean")
    def reaches(x: pa.Array, y: pa.Array) -> pa.Array:
        out = []
        for p, q in zip(x, y):
            p, q = np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)
            both = int(within(p, q).sum())
            out.append((100 + percent) * both >= percent * (len(p) + len(q)))
        return pa.array(out, pa.bool_())

    left = sets.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    return pairs.join(left, "a").join(right, "b").where(reaches("set_a", "set_b")).select("a", "b").distinct()


def sets_of(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """(id, set): the exact sets of the named documents, read again from their texts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for piece in pieces(batch.column(1)):
                own = batch.column(0).slice(at, len(piece)).cast(pa.int64())
                at += len(piece)
                sets = [shingle_set(w, n).tobytes() for w in per_text(piece, sized=True)]
                yield released(pa.RecordBatch.from_arrays([own, pa.array(sets, pa.binary())], names=["id", "set"]))

    ids = stored(ids.select(F.col("id").alias("id")).distinct(), "ids")
    return docs.join(small(ids, ids.count(), 16), "id", "left_semi").mapInArrow(scan, "id long, set binary")


def jaccard_components(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80
) -> DataFrame:
    """(id, n_shingles, component_id) for each row of documents."""
    bounded_memory(documents.sparkSession)
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    scanned = stored(read_sets(docs, n), "sets")
    rows = scanned.where("not extra").select("id", "n_shingles", "digest")

    # Heavy shingles: at most HEAVY_SHARE times the mean set size of them, however many texts there are.
    total = rows.count()
    heavy = (
        scanned.where("extra").select(F.explode("heavy").alias("h"), "n_shingles")
        .groupBy("h").agg(F.sum("n_shingles").alias("seen")).where(F.col("seen") >= total / 8).select("h")
    )
    heavy = np.array([r.h for r in heavy.collect()], np.int64).view(np.uint64)

    named = rows.where("id is not null and n_shingles > 0")
    classes = named.groupBy("digest").agg(F.min("id").alias("rep"))
    reps = stored(named.join(classes, "digest").select("id", "rep").distinct(), "reps")
    prefixes = stored(read_prefixes(docs, n, percent, heavy), "prefixes")

    # Buckets of two texts or more; of buckets with the same members one is enough.
    entries = prefixes.select("node", F.explode("keys").alias("key"))
    buckets = (
        entries.groupBy("key")
        .agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("times"),
             F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("members"))
        .where("low != high")
        .groupBy("low", "high", "times", "members").agg(F.min("key").alias("key"))
    )
    buckets = stored(buckets.select("key", "low"), "buckets")
    family = entries.join(small(buckets, buckets.count(), 32), "key").select("low", "node").distinct()
    at_node = reps.select(F.col("id").alias("node"), F.col("rep"))
    at_low = reps.select(F.col("id").alias("low"), F.col("rep").alias("center"))
    family = family.join(at_node, "node").join(at_low, "low").select(F.col("center").alias("low"), F.col("rep").alias("node"))
    points = prefixes.select("node", "size", "point").dropDuplicates(["node", "point"])
    family = stored(family.distinct().join(points, "node"), "family")

    stars = family.where("low != node").select(F.col("low").alias("a"), F.col("node").alias("b"))
    fine = prefixes.where("fine is not null").select(F.col("node").alias("id"), "size", "fine")
    links = checked(docs, fine, stored(within_bound(stars, points, percent), "bounded"), n, percent)
    for best in (True, False):
        found = stored(pairs_between(family, links, percent, best), "pairs")
        links = links.unionByName(checked(docs, fine, found, n, percent))

    copies = reps.where("id != rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    roots = components(named.select("id").distinct(), copies.unionByName(links))
    return rows.join(roots, "id", "left").select(
        "id", "n_shingles", F.coalesce("root", "id").alias("component_id")
    )


def checked(docs: DataFrame, fine: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs that are links: those that pass the fine bound, by their exact sets."""
    pairs = stored(refined(pairs, fine, percent), "refined")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    return stored(verified(pairs, stored(sets_of(docs, ends, n), "ends"), percent), "links")


def refined(pairs: DataFrame, fine: DataFrame, percent: int) -> DataFrame:
    """Leaves out pairs of two large sets whose counts in FINE_GROUPS groups rule the Jaccard out."""

    @F.arrow_udf("boolean")
    def allows(sa: pa.Array, fa: pa.Array, sb: pa.Array, fb: pa.Array) -> pa.Array:
        out = []
        for size_a, a, size_b, b in zip(sa, fa, sb, fb):
            a, b = (unpack([x.as_py()], FINE_GROUPS)[0] for x in (a, b))
            bound = int(np.minimum(a, b).sum(dtype=np.int64))
            out.append((100 + percent) * bound >= percent * (size_a.as_py() + size_b.as_py()))
        return pa.array(out, pa.bool_())

    ends = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    own = stored(fine.join(small(ends, ends.count(), 16), "id", "left_semi"), "fine")
    left = own.select(F.col("id").alias("a"), F.col("size").alias("sa"), F.col("fine").alias("fa"))
    right = own.select(F.col("id").alias("b"), F.col("size").alias("sb"), F.col("fine").alias("fb"))
    large = own.select("id").distinct()
    both = pairs.join(large.withColumnRenamed("id", "a"), "a", "left_semi").join(large.withColumnRenamed("id", "b"), "b", "left_semi")
    kept = both.join(left, "a").join(right, "b").where(allows("sa", "fa", "sb", "fb")).select("a", "b").distinct()
    return pairs.join(both, ["a", "b"], "left_anti").unionByName(kept)


def pairs_between(family: DataFrame, links: DataFrame, percent: int, best: bool) -> DataFrame:
    """Pairs (a, b) of one family but two components that pass the bound; with best, one for each text."""
    nodes = family.select(F.col("node").alias("id")).distinct()
    roots = stored(components(nodes, links), "roots")
    open_ = family.join(roots.withColumnRenamed("id", "node"), "node")
    mixed = (
        open_.groupBy("low").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("n"))
        .where("r0 != r1").select("low", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    open_ = open_.join(mixed, "low")
    own = F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks").cast("long")).cast("int")
    open_ = open_.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = open_.select(
        "low", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "root", "size", "point",
    )
    dealt = dealt.repartition("low", "i", "j").sortWithinPartitions("low", "i", "j")
    pairs = dealt.mapInArrow(block_pairs(percent, best), "a long, b long, share double")
    if best:
        pairs = pairs.groupBy("a").agg(F.max_by("b", F.struct("share", -F.col("b"))).alias("b"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def within_bound(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose points allow the Jaccard."""

    @F.pandas_udf("boolean")
    def allows(sa: pd.Series, pa_: pd.Series, sb: pd.Series, pb: pd.Series) -> pd.Series:
        bound = np.minimum(unpack(pa_.tolist()), unpack(pb.tolist())).sum(axis=1, dtype=np.int64)
        return pd.Series((100 + percent) * bound >= percent * (sa.to_numpy() + sb.to_numpy()))

    left = points.select(F.col("node").alias("a"), F.col("size").alias("sa"), F.col("point").alias("pa"))
    right = points.select(F.col("node").alias("b"), F.col("size").alias("sb"), F.col("point").alias("pb"))
    return pairs.join(left, "a").join(right, "b").where(allows("sa", "pa", "sb", "pb")).select("a", "b").distinct()


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0B\f\r]+') AS ws FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS ss FROM w),
e AS (SELECT doc_id, unnest(ss) AS sh FROM s),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both
  FROM e x JOIN e y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b
  WHERE 100 * n_both >= 80 * (len(x.ss) + len(y.ss) - n_both)),
g AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS id, doc_id AS root FROM s UNION SELECT g.b, r.root FROM r JOIN g ON g.a = r.id)
SELECT s.doc_id, CAST(len(s.ss) AS BIGINT) AS n_shingles, min(r.root) AS component_id
FROM s JOIN r ON r.id = s.doc_id GROUP BY s.doc_id, s.ss
"""


def op8_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    out = jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.withColumnRenamed("id", "doc_id")
