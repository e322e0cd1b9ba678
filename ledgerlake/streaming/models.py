"""Series models that are refitted as points arrive, from sums kept by day.

An append reads the batch's points and the sums of its days, never earlier points. A point that
comes again replaces nothing by itself: a day is sent whole, as the daily marts do, and replaces the
day's sums.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import AsOf, as_date
from ledgerlake.operators import series
from ledgerlake.sources.versioned import Lake, folder

SUMS_SCHEMA = "series string, dow int, n double, st double, stt double, sy double, syy double, sty double, dt date, month string"
START_SCHEMA = "series string, t0 double, y0 double, part int"


def append_days(points: DataFrame, root: str, source: str = "", batch_id: int | None = None) -> None:
    """Fold whole days of points (series, ts, y) into the kept sums; other days of the series stay."""
    spark = points.sparkSession
    lake, version = Lake(spark, root), uuid.uuid4().hex
    if lake.done(source, batch_id):
        return
    points = points.where("ts is not null").persist()
    try:
        known = lake.read("origins", START_SCHEMA).drop("part")
        fresh = series.origins(points.join(known.select("series"), "series", "left_anti"))
        starts = lake.stage(known.unionByName(fresh).withColumn("part", F.lit(0)), "origins", "part", version)
        start = lake.staged("origins", START_SCHEMA, version).drop("part")
        sums = series.day_sums(points, start)
        month = F.date_format("dt", "yyyy-MM").alias("month")
        days = points.select("series", F.to_date("ts").alias("dt")).distinct()
        # Stored by month, as a day's sums are a few rows; the list of touched months is short.
        folders = [folder("month", r.month) for r in days.select(month).distinct().collect()]
        kept = lake.read("sums", SUMS_SCHEMA, folders).join(days, ["series", "dt"], "left_anti")
        staged = lake.stage(kept.unionByName(sums.withColumn("month", month)), "sums", "month", version)
        lake.publish({"origins": starts, "sums": {**dict.fromkeys(folders), **staged}}, source, batch_id)
    finally:
        points.unpersist()


def fitted(spark: SparkSession, root: str, before: AsOf | None = None) -> tuple[DataFrame, DataFrame]:
    """(model, effects) of all kept days, or of those before a date."""
    lake = Lake(spark, root)
    sums = lake.read("sums", SUMS_SCHEMA).drop("month")
    if before is not None:
        sums = sums.where(F.col("dt") < F.lit(as_date(before)))
    return series.fit_sums(sums, lake.read("origins", START_SCHEMA).drop("part"))


def forecast(spark: SparkSession, root: str, horizon: int, interval: float = 0.90) -> DataFrame:
    return series.ahead(*fitted(spark, root), horizon, interval)


def anomalies(evaluate: DataFrame, root: str, before: AsOf, interval: float = 0.95) -> DataFrame:
    """Points checked against the model of the days before a date."""
    return series.flagged(evaluate, *fitted(evaluate.sparkSession, root, before), interval)
