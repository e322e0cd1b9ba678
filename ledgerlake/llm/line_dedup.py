"""Line deduplication: normalised lines found in many documents are dropped everywhere.

Texts are split at line feeds, lines are normalised to keys and hashed to 128 bits, the distinct
documents of each hash are counted, and the lines whose hash reaches the threshold go. The rest is
put together again by position. Only hashes are exploded and shuffled for the counts, with equal
ones combined before the shuffle, so a line that a third of all documents hold weighs no more than
one row per task. The lines to drop meet the documents' hashes in a join (broadcast where the
counted hashes are few) and come back as positions; whole texts move once at most.

Defined cases: a null or empty text is one empty line; keys shorter than min_chars (so empty lines)
always stay; a text of which every line goes is the empty text; rows that share an id are one
document where documents are counted, and rows without an id are told apart by their text; every
row gives one row of the result, repeated rows as well.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import doc_key, small, stored

MIN_DOCS = 10
MIN_CHARS = 1
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


def normalised(line: Column) -> Column:
    """The key of a line: blanks stripped at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(k_id, k_text, pos, h1, h2) of every line whose key is long enough; docs: k_id, k_text, lines."""
    lines = docs.select("k_id", "k_text", F.posexplode("lines").alias("pos", "line"))
    keys = lines.select("k_id", "k_text", "pos", normalised(F.col("line")).alias("key"))
    keys = keys.where(F.length("key") >= min_chars)
    return keys.select("k_id", "k_text", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def repeated_lines(hashes: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, n_docs): the lines that at least min_docs documents hold."""
    # Rows without an id are told apart by text, all others by id alone.
    own = F.when(F.col("k_id").isNull(), F.col("k_text"))
    held = hashes.select("h1", "h2", "k_id", own.alias("k_own")).distinct()
    counted = held.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"))
    return counted.where(F.col("n_docs") >= min_docs)


def drop_repeated_lines(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS
) -> DataFrame:
    """(id, n_lines, n_dropped, kept): one row for each document, with the text that is left."""
    key_id, key_text = doc_key(id_col, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = documents.select(key_id, key_text, text.alias("text"))
    docs = docs.select("k_id", "k_text", F.split("text", "\n", -1).alias("lines"))
    hashes = stored(line_hashes(docs, min_chars), "line-hashes")
    goes = stored(repeated_lines(hashes, min_docs).select("h1", "h2"), "repeated-lines")
    found = hashes.join(small(goes, goes.count(), 64), ["h1", "h2"]).select("k_id", "k_text", "pos")
    places = found.groupBy("k_id", "k_text").agg(F.collect_set("pos").alias("goes"))
    places = stored(places, "dropped-places")
    measured = places.agg(F.count("*").alias("n"), F.sum(F.size("goes")).alias("cells")).first()
    same = F.col("k_id").eqNullSafe(F.col("p_id")) & (F.col("k_text") == F.col("p_text"))
    places = places.select(F.col("k_id").alias("p_id"), F.col("k_text").alias("p_text"), "goes")
    rows = docs.join(small(places, measured.n, 64 + 4 * ((measured.cells or 0) // max(measured.n, 1) + 1)), same, "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("goes"))
    kept = F.when(F.col("goes").isNull(), F.col("lines")).otherwise(F.transform(stay, lambda i: F.get("lines", i)))
    return rows.select(
        F.col("k_id").alias("id"), F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.when(F.col("goes").isNotNull(), F.size("goes")), F.lit(0)).cast("long").alias("n_dropped"), F.array_join(kept, "\n").alias("kept"),
    )


def op13_line_dedup(spark, sf_dir: str) -> DataFrame:
    done = drop_repeated_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return done.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM docs),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
goes AS (
  SELECT key FROM keyed WHERE length(key) >= 1
  GROUP BY key HAVING count(DISTINCT CASE WHEN doc_id IS NULL THEN 'row ' || r ELSE 'id ' || doc_id END) >= 10),
marked AS (SELECT keyed.*, goes.key IS NOT NULL AS gone FROM keyed LEFT JOIN goes USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""
