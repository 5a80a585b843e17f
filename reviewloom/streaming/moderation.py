"""Score submissions as they arrive, with the rules of the batch job.

Rules are column expressions or loaded models, set up once when the query starts and applied to every
micro-batch. There is no state, so a restart from the checkpoint repeats at most the last batch, and the file
sink commits each batch once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from reviewloom.operators.moderate import Rule, moderate

MAX_FILES = 1_000


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int = MAX_FILES,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Files of a folder as a stream; the schema is given, never guessed.

    A batch takes at most ``max_files_per_trigger`` files, or with ``max_bytes_per_trigger`` files of about that many
    bytes together instead, so a backlog is worked off in batches of bounded size.
    """
    bound = ("maxFilesPerTrigger", max_files_per_trigger) if max_bytes_per_trigger is None else ("maxBytesPerTrigger", max_bytes_per_trigger)
    return spark.readStream.schema(schema).format(fmt).option(*bound).load(path)


def requests_to_texts(stream: DataFrame, col: str = "value", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Texts out of scoring requests ``{"data": [text, ...]}`` or ``{"data": text}``."""
    body = F.col(col)
    many = F.from_json(body, "data array<string>")["data"]
    one = F.array(F.get_json_object(body, "$.data"))
    is_list = F.get_json_object(body, "$.data").startswith("[") & many.isNotNull()
    return stream.select(*keep, F.explode(F.when(is_list, many).otherwise(one)).alias(text_col))


def moderate_stream(
    stream: DataFrame,
    text_col: str,
    rules: Sequence[Rule | Callable[[DataFrame], DataFrame]],
    out_path: str,
    checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Start writing moderated rows as Parquet. ``available_now`` stops after the input present now."""
    writer = (
        moderate(stream, text_col, rules)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", out_path)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
