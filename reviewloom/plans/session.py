"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Reviews can be long: keep the batches that go to Python small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings this package relies on: adaptive execution, skew splitting, UTC, Arrow."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    It lives under the session's ``spark.checkpoint.dir``. Only a local session without that setting
    gets a temporary folder of this machine, remembered for the rest of the session.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="reviewloom-")
        context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df, purpose: str = "stage"):
    """Write a frame to the shared folder and read it back, so later work restarts from the files."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """At most ``rows`` rows per Arrow batch in jobs that start inside, for rows that are long; then as before."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)
