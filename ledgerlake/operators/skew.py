"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

from ledgerlake.session import scratch_dir

# A key is hot when it holds more than 1 / HOT_SHARE of all rows; so fewer than
# HOT_SHARE keys can be hot, whatever the data, and that table is safe to broadcast.
HOT_SHARE = 1000
_SPREAD = 1 << 20


def attach_group_stats(
    rows: DataFrame, stats: DataFrame, keys: list[str], count_col: str, spread_by: str
) -> DataFrame:
    """Left join of per-key statistics back to the rows they came from.

    `stats` has one row per key with its row count in `count_col`. Hot keys are looked up in a
    broadcast of fewer than HOT_SHARE rows; their rows then travel under a random salt, so no
    reducer receives a hot key whole. All other keys take an ordinary equi-join.
    """
    values = [c for c in stats.columns if c not in keys and c != count_col]
    # All uses of `stats` ask for the same columns, so they share one aggregation.
    sums = F.struct(F.sum(count_col).alias("rows"), *[F.count(v) for v in values])
    total = stats.agg(sums.alias("t")).scalar()["rows"]
    hot = stats.where(F.col(count_col) * HOT_SHARE > total).select(
        *[F.col(k).alias(f"_h_{k}") for k in keys],
        *[F.col(v).alias(f"_h_{v}") for v in values],
        F.lit(True).alias("_hot"),
    )
    on_hot = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys]
    )
    marked = rows.join(F.broadcast(hot), on_hot, "left").withColumn(
        "_salt",
        F.when(F.col("_hot"), F.pmod(F.xxhash64(spread_by), F.lit(_SPREAD))).otherwise(F.lit(-1)),
    )
    cold = stats.select(
        *[F.col(k).alias(f"_c_{k}") for k in keys],
        *[F.col(v).alias(f"_c_{v}") for v in values],
        # -1 for every key that has rows. A plain literal would be folded out of the join key.
        F.when(F.col(count_col) > 0, F.lit(-1)).otherwise(F.lit(-2)).cast("long").alias("_c_salt"),
    )
    on_cold = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in keys],
        F.col("_salt") == F.col("_c_salt"),
    )
    joined = marked.join(cold, on_cold, "left")
    return joined.select(
        *rows.columns,
        *[
            F.when(F.col("_hot"), F.col(f"_h_{v}")).otherwise(F.col(f"_c_{v}")).alias(v)
            for v in values
        ],
    )


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether a frame has at most max_rows rows; reads no further than it has to."""
    return df.limit(max_rows + 1).count() <= max_rows


BROADCAST_BYTES = 32 << 20
ROW_BYTES = 32  # what a row of a broadcast takes beside its values


def _width(column: Column, kind: DataType) -> Column:
    """Bytes of a value: measured for texts and arrays, fixed for all else."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0))
    if isinstance(kind, ArrayType):
        items = F.aggregate(F.transform(column, lambda x: _width(x, kind.elementType)), F.lit(0), lambda s, x: s + x)
        return F.lit(8) + F.coalesce(items, F.lit(0))
    if isinstance(kind, StructType):
        return reduce(lambda a, b: a + b, [_width(column[f.name], f.dataType) for f in kind.fields], F.lit(8))
    if isinstance(kind, MapType):
        return _width(F.map_keys(column), ArrayType(kind.keyType)) + _width(F.map_values(column), ArrayType(kind.valueType))
    return F.lit(8)


def fits_bytes(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the values of a frame take at most max_bytes, by measuring them; stops at the rows that could not fit."""
    rows = max_bytes // (ROW_BYTES + 8 * len(df.columns)) + 1
    width = reduce(lambda a, b: a + b, [_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields], F.lit(ROW_BYTES))
    found = df.limit(rows).agg(F.count("*").alias("n"), F.sum(width.cast("long")).alias("bytes")).first()
    return found.n < rows and (found.bytes or 0) <= max_bytes


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    spread_by: str,
    how: str = "inner",
    max_broadcast_rows: int = 200_000,
    max_broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: int = HOT_SHARE,
) -> DataFrame:
    """Join a lookup table whose keys may be hot on the row side.

    The lookup is written to scratch once, so that measuring it does not compute it again. One whose
    rows and bytes are under the bounds is broadcast. A larger one is joined by shuffle:
    keys with more than 1 / hot_share of the rows (so fewer than that many keys) are counted, and
    their rows are split into as many parts as their share asks for, with the lookup's row copied
    to each. All other keys keep one part.
    """
    path = scratch_dir(rows.sparkSession, "lookup")
    lookup.write.parquet(path)
    lookup = rows.sparkSession.read.schema(lookup.schema).parquet(path)
    if fits(lookup, max_broadcast_rows) and fits_bytes(lookup, max_broadcast_bytes):
        return rows.join(F.broadcast(lookup), keys, how)
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    hot = counts.where(F.col("_n") * hot_share > total).select(*keys, F.ceil(F.col("_n") * hot_share / total).cast("int").alias("_parts"))
    hot = F.broadcast(hot)  # fewer than hot_share rows
    parts = F.coalesce("_parts", F.lit(1))
    salted = rows.join(hot, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(spread_by), parts.cast("long")).cast("int")).drop("_parts")
    copies = lookup.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


def spread(scan: DataFrame) -> DataFrame:
    """Deal out the rows of a scan that has fewer splits than there are cores.

    A single row group cannot be split, so heavy per-row work would run in one task. A scan with
    enough splits is returned as it is, without a shuffle.
    """
    if scan.isStreaming:
        return scan
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
