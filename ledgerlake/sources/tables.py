"""Sinks: append with defaults, overwrite, create-or-replace, reload, partition overwrite."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _aligned(df: DataFrame, table: str) -> DataFrame:
    """The frame in the table's column order; columns that the table lacks are an error, not dropped."""
    known = df.sparkSession.table(table).columns
    extra = [c for c in df.columns if c.lower() not in {k.lower() for k in known}]
    if extra:
        raise ValueError(f"{table} has no columns {extra}")
    return df.select(*known)


def append_by_name(df: DataFrame, table: str, defaults: Mapping[str, Column] | None = None) -> None:
    """Append to a table matching columns by name; absent columns take their default."""
    for name, value in (defaults or {}).items():
        if name not in df.columns:
            df = df.withColumn(name, value)
    if df.sparkSession.catalog.tableExists(table):
        df = _aligned(df, table)
    df.write.mode("append").saveAsTable(table)


def overwrite(df: DataFrame, table: str, partition_by: list[str] | None = None) -> DataFrame:
    """Replace a table and return it, so counts read the written rows, not the plan again."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def ctas(spark: SparkSession, table: str, sql: str) -> DataFrame:
    return overwrite(spark.sql(sql), table)


def reload(df: DataFrame, table: str) -> DataFrame:
    """Truncate and refill with the table's own column order."""
    if df.sparkSession.catalog.tableExists(table):
        df = _aligned(df, table)
    return overwrite(df, table)


def overwrite_partitions(df: DataFrame, path: str, by: str) -> None:
    """Rewrite only the partitions that occur in the frame.

    Rebalancing by the partition column gives a small partition one file and lets AQE cut a
    large one into several, instead of one file per task and partition.
    """
    (
        df.hint("rebalance", by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def metadata_session(spark: SparkSession) -> SparkSession:
    """A session whose Parquet reader answers counts, minima and maxima from the files' footers."""
    other = spark.newSession()
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    others = [s for s in other.conf.get("spark.sql.sources.useV1SourceList").split(",") if s != "parquet"]
    other.conf.set("spark.sql.sources.useV1SourceList", ",".join(others))
    other.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return other


def footer_counts(spark: SparkSession, paths: Mapping[str, str], ranges: Mapping[str, str]) -> DataFrame:
    """(t, n_rows, lo, hi) of Parquet tables: rows and the range of a column, without reading a row.

    ranges: for each table a column of a whole number, date or double type.
    """
    other, out = metadata_session(spark), None
    for name, path in paths.items():
        c = F.col(ranges[name])
        one = other.read.parquet(path).agg(F.count("*").alias("n_rows"), F.min(c).alias("lo"), F.max(c).alias("hi"))
        # A table without row groups leaves the count empty although it is declared never null.
        one = one.select(F.lit(name).alias("t"), F.greatest("n_rows", F.lit(0).cast("long")).alias("n_rows"), F.col("lo").cast("string").alias("lo"), F.col("hi").cast("string").alias("hi"))
        out = one if out is None else out.unionByName(one)
    return out
