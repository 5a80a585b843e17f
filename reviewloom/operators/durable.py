"""Answers of external models, kept by content: no text is sent again once its answer is stored.

A store is an append-only dataset of the registry. Each text stands under the hash of its content; the texts a store
does not know yet are sent in waves, and every wave is committed as a version of its own before the next begins. A
driver that dies loses the wave it was in and a lost executor the tasks it was running; whoever calls next sends only
what is missing. One store belongs to one model with one set of settings.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions.hashing import text_key
from reviewloom.operators.external import Encoder, TextClient, embed, embedding_column, generate
from reviewloom.plans.bounded import join_by_key, lookup_join
from reviewloom.plans.session import cut_lineage, shared_dir
from reviewloom.sources.registry import Registry

WAVE_ROWS = 1_000_000
WAVE_TASKS = 64
#: Files per wave in which new texts wait.
_WAVE_FILES = 16

Ask = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Answers:
    """A store: rows ``(_key, <columns>, error)``, one or more per text; ``error`` is null where the call worked."""

    registry: Registry
    name: str
    columns: str

    @property
    def schema(self) -> T.StructType:
        columns = T.StructType.fromDDL(self.columns).fields
        return T.StructType([T.StructField("_key", T.BinaryType()), *columns, T.StructField("error", T.StringType())])

    def rows(self) -> DataFrame:
        """All committed rows, with the ``version`` that brought them."""
        versions = self.registry.versions(self.name)
        if not versions:
            return self.registry.spark.createDataFrame([], self.schema.add("version", T.IntegerType()))
        return self.registry.read_versions(self.name, versions).select(*self.schema.names, "version")

    def append(self, answers: DataFrame) -> int:
        return self.registry.write_dataset(answers.select(*self.schema.names), self.name)

    def current(self) -> DataFrame:
        """One answer per text: the first that worked, else the last failure.

        Only keys and versions are counted; texts that were answered in several versions (failures that were sent
        again, or drivers that ran side by side) are few and looked up.
        """
        rows = self.rows()
        worked = F.when(F.col("error").isNull(), F.col("version"))
        keys = rows.groupBy("_key").agg(F.min(worked).alias("_good"), F.min("version").alias("_first"), F.max("version").alias("_last"))
        again = keys.filter("_first < _last").select("_key", F.coalesce("_good", "_last").alias("_pick"))
        picked = lookup_join(rows, again, "_key", "left", spread_by=["version"])
        return picked.filter(F.col("_pick").isNull() | (F.col("_pick") == F.col("version"))).drop("_pick")


def _keyed(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("_key", text_key(text))


def _key_counts(keyed: DataFrame) -> DataFrame:
    return cut_lineage(keyed.filter(F.col("_key").isNotNull()).groupBy("_key").agg(F.count(F.lit(1)).alias("n")), "keys")


def ask_new(
    df: DataFrame, text: str, store: Answers, ask: Ask, wave_rows: int = WAVE_ROWS, tasks: int = WAVE_TASKS,
    max_waves: int | None = None, counts: DataFrame | None = None,
) -> int:
    """Send every text of ``df`` without a good answer once, in waves of about ``wave_rows``; returns the waves left.

    ``ask`` maps ``(_key, text)`` to the rows of the store. At most ``tasks`` tasks call at a time, and each holds a
    share of one wave only. Null texts are not sent. ``max_waves`` ends the call early.
    """
    keyed = _keyed(df.select(F.col(text).alias("text")), "text")
    counts = _key_counts(keyed) if counts is None else counts
    known = store.rows().filter("error is null").select("_key")
    new = cut_lineage(counts.select("_key").join(known, "_key", "left_anti"), "new")
    missing = new.count()
    if not missing:
        return 0
    waves = -(-missing // wave_rows)
    wanted = join_by_key(keyed.filter(F.col("_key").isNotNull()).withColumn("_row", F.monotonically_increasing_id()), new, "_key", counts, "left_semi", ["_row"])
    once = wanted.select("_key", "text").dropDuplicates(["_key"])
    dealt = once.withColumn("_wave", F.pmod(F.xxhash64("_key"), F.lit(waves)).cast("int"))
    path = shared_dir(df.sparkSession, "waves")
    dealt.repartition("_wave", F.pmod(F.hash("_key"), F.lit(_WAVE_FILES))).write.partitionBy("_wave").parquet(path)
    waiting = df.sparkSession.read.schema("_key binary, text string, _wave int").parquet(path)
    todo = waves if max_waves is None else min(waves, max_waves)
    for wave in range(todo):
        store.append(ask(waiting.filter(F.col("_wave") == wave).select("_key", "text").repartition(tasks, "_key")))
    return waves - todo


def answered(df: DataFrame, text: str, store: Answers, ask: Ask, id_col: str, **options) -> DataFrame:
    """Rows of ``df`` with the stored answer's columns, ``error`` and ``version``; what is not stored is asked first.

    A row stands once per row of its answer. Null texts keep their row, with nulls.
    """
    keyed = _keyed(df, text)
    counts = _key_counts(keyed)
    ask_new(df, text, store, ask, counts=counts, **options)
    return join_by_key(keyed, store.current(), "_key", counts, "left", [id_col]).drop("_key")


def vector_store(registry: Registry, model: str) -> Answers:
    return Answers(registry, "vectors-" + "".join(c if c.isalnum() else "-" for c in model), "vector array<float>")


def embed_by_content(
    df: DataFrame, id_col: str, text: str, model: str, encoder_factory: Callable[[], Encoder], registry: Registry, **options
) -> DataFrame:
    """Add a model's vectors of a text column; only texts that no earlier call has embedded meet the encoder.

    An existing column of that name is replaced. Null texts get a null vector.
    """
    column = embedding_column(text, model)
    vector = embedding_column("text", model)

    def ask(texts: DataFrame) -> DataFrame:
        made = embed(texts, "text", model, encoder_factory)
        return made.select("_key", F.col(vector).alias("vector"), F.lit(None).cast("string").alias("error"))

    kept = [c for c in df.columns if c != column]
    ids = df.select(F.struct(*kept).alias("_r"), F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    out = answered(ids, "_text", vector_store(registry, model), ask, "_id", **options)
    return out.select("_r.*", F.col("vector").alias(column))


def generate_durably(
    prompts: DataFrame, client_factory: Callable[[], TextClient], store: Answers, n: int = 1, id_col: str = "prompt_id",
    prompt_col: str = "prompt", attempts: int = 1, wait: float = 1.0, threads: int = 8, **options,
) -> DataFrame:
    """As ``external.generate``, with replies stored by prompt before they are used.

    Equal prompts are sent once and share their replies. A prompt that failed is sent again by the next call.
    """

    def ask(texts: DataFrame) -> DataFrame:
        return generate(texts, client_factory, n, "_key", "text", attempts, wait, threads=threads)

    rows = prompts.select(F.col(id_col).alias("_id"), F.col(prompt_col).alias("_prompt")).filter("_prompt is not null")
    out = answered(rows, "_prompt", store, ask, "_id", **options)
    return out.select(F.col("_id").alias(id_col), "reply_no", "text", "error")


def reply_store(registry: Registry, name: str) -> Answers:
    """Replies of one text client, prompt settings included in the name."""
    return Answers(registry, name, "reply_no int, text string")
