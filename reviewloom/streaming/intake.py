"""Submissions as they arrive: what is sent again is dropped, and every batch becomes a version of a dataset."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from reviewloom.sources.registry import Registry
from reviewloom.streaming.moderation import read_stream

MAX_BYTES = 8 * 1024**3
ARRIVED = "arrived"


def read_arrivals(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_bytes: int = MAX_BYTES
) -> DataFrame:
    """Files of a folder as a stream, oldest first, with the time at which each row's file was written in ``arrived``.

    A batch takes about ``max_bytes`` of files, and at least one file.
    """
    stream = read_stream(spark, path, schema, fmt, max_bytes_per_trigger=max_bytes)
    return stream.select("*", F.col("_metadata.file_modification_time").alias(ARRIVED))


def first_arrivals(stream: DataFrame, id_col: str, within: str = "7 days", arrived: str = ARRIVED) -> DataFrame:
    """Rows whose id has not come before.

    The time that counts is that of arrival, which only grows, so an old submission that comes late is never dropped.
    An id is remembered for ``within`` from its first arrival; sent again later than that, it counts as new, and what
    is remembered stays bounded. Of rows of one batch with one id any one is kept. Rows without an id are told apart
    by their content.
    """
    content = [c for c in stream.columns if c not in (arrived, id_col)]
    other = F.when(F.col(id_col).isNull(), F.sha2(F.to_json(F.struct(*content)), 256)) if content else F.lit(None).cast("string")
    keyed = stream.withColumn("_content", other).withWatermark(arrived, within)
    return keyed.dropDuplicatesWithinWatermark([id_col, "_content"]).drop("_content")


def keep_versions(
    stream: DataFrame, registry: Registry, name: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Start writing each batch as one version of a dataset.

    A batch that is run again after a crash finds its version noted under the id of the query: if it was finished it
    stays, else it is written again in its place. So every batch is one version, whatever happens in between. Batches
    that only clear state make versions without rows. A new checkpoint is a new query and adds its own versions.
    """

    def write(batch: DataFrame, number: int) -> None:
        # The checkpoint holds the id of the query, which outlives restarts.
        query = json.loads(batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        registry.write_batch(batch, name, query, number)

    writer = stream.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
