"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def get_spark(app: str = "ledgerlake", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


ARROW_BATCH = 8 << 20
CODEC = "zstd"  # of stored raw records, typed rows and marts: texts take about two thirds of Spark's default


def prepare(spark: SparkSession) -> SparkSession:
    """Timestamps are stored without a zone, so every conversion has to happen in UTC.

    Rows go to Python in batches of about ARROW_BATCH bytes; by their number alone a batch of long
    texts, cut into words, would take a large share of an executor's memory.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH))
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Executors write here, so a machine-local folder only serves when the master is local.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/ledgerlake/{purpose}-{uuid.uuid4().hex}"
