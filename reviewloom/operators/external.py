"""External models behind injected clients: generation, rewriting, scoring, embedding, classification.

A factory builds the client once per task on the executor; batches arrive through Arrow. Results are keyed,
so that a repeated task overwrites rather than adds.
"""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions.hashing import DEFAULT_SEED
from reviewloom.functions.text import parse_reply, prefix_text
from reviewloom.operators.sampling import balance, sample_n
from reviewloom.operators.tables import concat_datasets, split_slice
from reviewloom.plans.session import cut_lineage, shared_dir

#: Bytes of prompts that one of a bounded number of tasks takes per wave; of a row besides its prompt.
WAVE_BYTES = 128 * 1024 * 1024
_ROW_BYTES = 16

# Calls handed to the threads before the oldest is waited for, per thread; replies that go back at a time.
_AHEAD = 8
_REPLY_CHARS = 1 << 20
_REPLY_ROWS = 1_000


@dataclass(frozen=True)
class EndpointDetails:
    """What a client factory needs to reach a service; secrets are resolved on the executor by name."""

    name: str
    url: str
    secret_name: str = ""
    content_field: str = "data"
    content_in_list: bool = False

    def request(self, text: str) -> dict:
        return {self.content_field: [text] if self.content_in_list else text}


class TextClient(Protocol):
    def generate(self, prompt: str, n: int) -> Sequence[str]: ...


class ScoreClient(Protocol):
    def score(self, texts: Sequence[str]) -> Sequence[tuple]: ...


class Encoder(Protocol):
    def encode(self, texts: Sequence[str]): ...


def _with_retries(call: Callable[[], Sequence[str]], attempts: int, wait: float):
    for attempt in range(1, attempts + 1):
        try:
            return list(call()), None
        except Exception as error:  # noqa: BLE001 - a failed call must not fail the job
            if attempt == attempts:
                return None, f"{type(error).__name__}: {error}"
            time.sleep(wait)


def generate(
    prompts: DataFrame,
    client_factory: Callable[[], TextClient],
    n: int = 1,
    id_col: str = "prompt_id",
    prompt_col: str = "prompt",
    attempts: int = 1,
    wait: float = 1.0,
    concurrency: int | None = None,
    threads: int = 8,
) -> DataFrame:
    """n replies per prompt as ``(id, reply_no, text, error)``; a failed prompt is one row with an error.

    ``concurrency`` bounds the number of tasks that call the service at a time, ``threads`` the calls in
    flight in each. Prompts beyond ``WAVE_BYTES`` for each of these tasks are sent in waves, one after the other, and
    the replies are stored in the shared folder before this returns; fewer are sent when the result is used.
    """
    rows = prompts.select(id_col, prompt_col)
    schema = T.StructType(
        [
            prompts.schema[id_col],
            T.StructField("reply_no", T.IntegerType()),
            T.StructField("text", T.StringType()),
            T.StructField("error", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = client_factory()
        with ThreadPoolExecutor(threads) as pool:
            yield from _replies(batches, lambda p: _with_retries(lambda: client.generate(p, n), attempts, wait), pool, threads)

    if not concurrency:
        return rows.mapInArrow(run, schema)
    # The batches of a stream are bounded by its trigger.
    size = 0 if rows.isStreaming else rows.agg(F.sum(F.octet_length(prompt_col).cast("bigint") + _ROW_BYTES)).first()[0] or 0
    waves = -(-size // (concurrency * WAVE_BYTES))
    if waves <= 1:
        return rows.repartition(concurrency, id_col).mapInArrow(run, schema)
    return _in_waves(rows, concurrency, waves, lambda part: part.mapInArrow(run, schema)).select(*schema.names)


def _replies(batches: Iterator[pa.RecordBatch], ask: Callable, pool: ThreadPoolExecutor, threads: int) -> Iterator[pa.RecordBatch]:
    """Replies to batches of ``(id, prompt)``, in their order and some megabytes at a time.

    Few calls wait for a thread, so neither prompts nor replies of a whole batch are held as Python objects.
    """
    waiting: deque = deque()
    out: list[tuple] = []
    size, kind = 0, None

    def flush() -> pa.RecordBatch:
        nonlocal out, size
        keys, numbers, texts, errors = zip(*out)
        out, size = [], 0
        columns = [pa.array(keys, kind.type), pa.array(numbers, pa.int32()), pa.array(texts, pa.string(), from_pandas=True), pa.array(errors, pa.string())]
        return pa.RecordBatch.from_arrays(columns, [kind.name, "reply_no", "text", "error"])

    def take() -> None:
        nonlocal size
        key, call = waiting.popleft()
        texts, error = call.result()
        out.extend([(key, 0, None, error)] if texts is None else [(key, i, text, None) for i, text in enumerate(texts, start=1)])
        size += sum(len(t) for t in texts or () if isinstance(t, str))

    for batch in batches:
        kind = batch.schema.field(0)
        for key, prompt in zip(batch.column(0), batch.column(1)):
            waiting.append((key.as_py(), pool.submit(ask, prompt.as_py())))
            if len(waiting) >= _AHEAD * threads:
                take()
            if size >= _REPLY_CHARS or len(out) >= _REPLY_ROWS:
                yield flush()
    while waiting:
        take()
        if size >= _REPLY_CHARS or len(out) >= _REPLY_ROWS:
            yield flush()
    if out:
        yield flush()


def _in_waves(rows: DataFrame, tasks: int, waves: int, ask: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``ask`` of all rows, of one wave after the other, by at most ``tasks`` tasks at a time.

    Rows are dealt by their content into ``tasks`` files a wave, written once; the results are read back from the shared folder.
    """
    spark = rows.sparkSession
    path, results = shared_dir(spark, "waves"), shared_dir(spark, "replies")
    dealt = rows.repartition(waves * tasks, *rows.columns).withColumn("_wave", F.pmod(F.spark_partition_id(), F.lit(waves)))
    dealt.write.partitionBy("_wave").parquet(path, compression="zstd")
    waiting = spark.read.schema(dealt.schema).parquet(path)
    for wave in range(waves):
        part = ask(waiting.filter(F.col("_wave") == wave).drop("_wave").coalesce(tasks))
        part.write.mode("append").parquet(results, compression="zstd")
    return spark.read.schema(part.schema).parquet(results)


def rewrite(
    df: DataFrame,
    client_factory: Callable[[], TextClient],
    id_col: str,
    text_col: str,
    template: str = "{text}",
    attempts: int = 5,
    wait: float = 1.0,
    concurrency: int | None = None,
) -> DataFrame:
    """One rewritten text per row, e.g. in plainer language, with the reason where it failed.

    ``template`` surrounds the text; failing calls are tried again.
    """
    before, after = template.split("{text}")
    prompts = df.filter(F.col(text_col).isNotNull()).select(
        id_col, F.concat(F.lit(before), F.col(text_col), F.lit(after)).alias("prompt")
    )
    replies = generate(prompts, client_factory, 1, id_col, "prompt", attempts, wait, concurrency)
    return replies.select(id_col, F.col("text").alias(text_col), "error")


def split_errors(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and quarantined rows. Results are stored first, so no external call happens twice."""
    stored = cut_lineage(results, "external")
    return stored.filter(F.col("error").isNull()).drop("error"), stored.filter(F.col("error").isNotNull())


def rewrite_dataset(registry, name: str, client_factory, id_col: str, text_col: str, label_col: str, **options) -> tuple[str, DataFrame]:
    """Rewrite a registered dataset into ``<name>_lowered``, labelled 1; returns its name and the failures."""
    good, failed = split_errors(rewrite(registry.read_dataset(name), client_factory, id_col, text_col, **options))
    target = f"{name}_lowered"
    registry.write_dataset(good.withColumn(label_col, F.lit(1)), target)
    return target, failed


def score_external(
    df: DataFrame,
    client_factory: Callable[[], ScoreClient],
    text_col: str,
    label_type: str = "string",
    batch_size: int = 64,
) -> DataFrame:
    """Add ``label`` and ``probability`` from an external model; both are null where scoring failed.

    Texts go out in batches. A batch that fails is sent again text by text, so one bad text costs itself.
    """
    schema = f"label {label_type}, probability double"

    @F.pandas_udf(schema)
    def scores(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        client = client_factory()

        def attempt(texts):
            try:
                return list(client.score(texts))
            except Exception:  # noqa: BLE001 - a failed call must not fail the job
                return [attempt([t])[0] for t in texts] if len(texts) > 1 else [(None, None)]

        for texts in series:
            found: list[tuple] = [(None, None)] * len(texts)
            held = [i for i, t in enumerate(texts) if t is not None]
            for start in range(0, len(held), batch_size):
                part = held[start : start + batch_size]
                for i, result in zip(part, attempt([texts.iloc[i] for i in part])):
                    found[i] = result
            yield pd.DataFrame(found, columns=["label", "probability"])

    return df.withColumn("_score", scores.asNondeterministic()(text_col)).select(*df.columns, "_score.label", "_score.probability")


def embedding_column(text_col: str, model: str) -> str:
    """Name of the column that holds a model's vectors of a text column."""
    return f"embeddings_{text_col}{model}"


def embed(
    df: DataFrame, text_col: str, model: str, encoder_factory: Callable[[], Encoder], override: bool = False
) -> DataFrame:
    """Add a model's vectors of a text column, unless they are there and ``override`` is not set.

    The text gets the prefix the model expects. Rows without text get no vector.
    """
    name = embedding_column(text_col, model)
    if name in df.columns and not override:
        return df

    @F.pandas_udf("array<float>")
    def vectors(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = encoder_factory()
        for texts in series:
            held = [i for i, t in enumerate(texts) if t is not None]
            out: list = [None] * len(texts)
            for i, vector in zip(held, encoder.encode([texts.iloc[i] for i in held]) if held else ()):
                out[i] = [float(x) for x in vector]
            yield pd.Series(out)

    return df.withColumn(name, vectors.asNondeterministic()(prefix_text(text_col, model)))


def embed_all(
    df: DataFrame, text_col: str, encoders: Mapping[str, Callable[[], Encoder]], override: bool = False
) -> DataFrame:
    """Vectors of every listed model, from one read of the dataset."""
    for model, factory in encoders.items():
        df = embed(df, text_col, model, factory, override)
    return df


def embed_dataset(registry, name: str, text_col: str, encoders, override: bool = False) -> int | None:
    """Embed a registered dataset and register the result; None when there was nothing to do."""
    df = registry.read_dataset(name)
    out = embed_all(df, text_col, encoders, override)
    return None if out is df else registry.write_dataset(out, name)


# How the two kinds of language model want instruction and review put together.
PROMPT_SHAPES = {
    "general": ("Input: '", "'. Output: "),
    "chat": ("", ""),
}


def llm_classify(
    datasets: Sequence[DataFrame],
    y: str,
    id_col: str,
    text_col: str,
    client_factory: Callable[[], TextClient],
    instructions: str,
    mode: str = "chat",
    split: str = "test",
    balance_data: bool = False,
    n_to_sample: int = 0,
    seed: int = DEFAULT_SEED,
    **options,
) -> DataFrame:
    """Label reviews with a language model: ``(id, y, reply, prediction)``, prediction null on failure.

    Datasets are stacked, cut to a split, optionally balanced and sampled before any call is made.
    """
    rows = split_slice(concat_datasets(datasets), split).select(id_col, y, text_col)
    if balance_data:
        rows = balance(rows, y, id_col, seed)
    if n_to_sample > 0:
        rows = sample_n(rows, n_to_sample, id_col, seed)
    before, after = PROMPT_SHAPES[mode]
    prompts = rows.select(id_col, F.concat(F.lit(instructions + before), F.col(text_col), F.lit(after)).alias("prompt"))
    replies = generate(prompts, client_factory, 1, id_col, "prompt", **options).select(id_col, F.col("text").alias("reply"))
    return (
        rows.select(id_col, y)
        .join(replies, id_col, "left")
        .withColumn("prediction", parse_reply("reply", mode))
    )
