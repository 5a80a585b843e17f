"""Token counts per document by a map-side two-tier lookup; no pre-token of the counted texts is shuffled."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.base import query, slices, table
from reviewloom.llm.units import LONGEST_KEPT, UNIT, unit_ids


class TokenLengths(dict):
    """Token lengths of units: the table of frequent ones, then this worker's cache, then the tokenizer."""

    def __init__(self, path: str, frequent: dict[str, int], room: int):
        super().__init__(frequent)
        self.worker = unit_ids(path, room)

    def __missing__(self, unit: str) -> int:
        return len(self.worker[unit]) // 4

    def count(self, texts: list[str]) -> list[int]:
        self.worker.make_room()
        length, special = self.__getitem__, self.worker.special
        return [len(self.worker.whole(t)) // 4 if any(s in t for s in special) else sum(map(length, UNIT.findall(t))) for t in texts]


def frequent_lengths(docs: DataFrame, text: str, path: str, sample_docs: int, table_size: int) -> dict[str, int]:
    """Token lengths of the units most frequent in a random sample of the whole table; they only speed up the count."""

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = Counter(u for t in batch.column(0).to_pylist() for u in UNIT.findall(t or "") if len(u) <= LONGEST_KEPT)
            yield pa.RecordBatch.from_pydict({"unit": pa.array(seen, pa.string()), "n": pa.array(seen.values(), pa.int64())})

    share = min(1.0, sample_docs / max(1, docs.count()))
    sample = docs.select(F.col(text).alias("t")).sample(fraction=share, seed=9)
    top = (
        sample.mapInArrow(units, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "unit").limit(table_size)
    )
    encoder = unit_ids(path)
    return {r["unit"]: len(encoder[r["unit"]]) // 4 for r in top.collect()}


def count_tokens(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512,
    sample_docs: int = 2_000, table_size: int = 20_000, cache_size: int = 1_000_000,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row, in one pass without a shuffle.

    ``path`` names a byte-level BPE file of the tokenizers library. The broadcast table holds at most
    ``table_size`` units of ``LONGEST_KEPT`` characters, taken from a random sample of about ``sample_docs`` rows of
    the whole table; what it lacks is encoded once per worker process and kept for its later tasks, ``cache_size``
    units before it starts anew. Null and empty texts have no bytes and no tokens; texts of any length are counted
    whole; repeated rows and null ids are kept as they are. Other columns are not read, so their names can't clash.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    shared = context.broadcast(frequent_lengths(rows, "text", path, sample_docs, table_size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenLengths(path, shared.value, cache_size)
        for batch in slices(batches, "text", 1 << 20):
            text = batch.column("text")
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.compute.binary_length(text).cast(pa.int64()), pa.array(counter.count(text.to_pylist()), pa.int64())],
                names=["id", "n_bytes", "n_tokens"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    counted = rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
