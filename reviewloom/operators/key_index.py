"""An index of text hashes per dataset, kept beside the registry, for leakage checks that read no old texts.

A batch of a dataset is indexed once, as ``(key, n)``: 32 bytes and a count per different text. A check of new rows
joins their hashes with the stored ones, so its cost follows the new rows and the number of different old texts, not
the size of the old datasets.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.hashing import text_key
from reviewloom.plans.bounded import join_by_key
from reviewloom.plans.session import cut_lineage
from reviewloom.sources.registry import Registry

_SCHEMA = "key binary, n bigint, dataset string, batch string"


def key_counts(df: DataFrame, text: str) -> DataFrame:
    """``(key, n)`` of the texts of a frame, combined on the map side; null texts have no key."""
    keys = df.select(text_key(text).alias("key")).filter(F.col("key").isNotNull())
    return keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class KeyIndex:
    """Batches are datasets of the registry called ``<name>.<dataset>.<batch>``, whose latest version counts.

    So a batch that is indexed again, after a failure or a correction, replaces itself and is not counted twice.
    """

    registry: Registry
    name: str = "keys"

    def _stored(self, dataset: str, batch: str) -> str:
        for part in (dataset, batch):
            if not part or "." in part or "/" in part:
                raise ValueError(f"not a name for a dataset or batch: {part!r}")
        return f"{self.name}.{dataset}.{batch}"

    def batches(self) -> list[tuple[str, str]]:
        """``(dataset, batch)`` of all that is indexed."""
        names = (n.split(".") for n in self.registry.list_datasets() if n.startswith(f"{self.name}."))
        return [(parts[1], parts[2]) for parts in names if len(parts) == 3]

    def add(self, dataset: str, batch: str, df: DataFrame, text: str) -> int:
        """Index a batch of rows; returns the version of its entry."""
        return self.registry.write_dataset(key_counts(df, text), self._stored(dataset, batch))

    def entries(self, without: str | None = None) -> DataFrame:
        """``(key, n, dataset, batch)`` of all datasets, or of all but one."""
        parts = [
            self.registry.read_dataset(self._stored(d, b)).select("key", "n", F.lit(d).alias("dataset"), F.lit(b).alias("batch"))
            for d, b in self.batches() if d != without
        ]
        empty = self.registry.spark.createDataFrame([], _SCHEMA)
        return reduce(DataFrame.union, parts) if parts else empty

    def datasets_of(self, without: str | None = None) -> DataFrame:
        """``(key, dataset, n)``: occurrences of each text in each dataset, over its batches."""
        return self.entries(without).groupBy("key", "dataset").agg(F.sum("n").alias("n"))

    def shared(self) -> DataFrame:
        """``(key, n_datasets, n)`` of the texts that stand in two datasets or more."""
        every = self.datasets_of().groupBy("key").agg(F.count(F.lit(1)).alias("n_datasets"), F.sum("n").alias("n"))
        return every.filter("n_datasets > 1")

    def leaks(self, dataset: str, df: DataFrame, id_col: str, text: str) -> DataFrame:
        """``(id, dataset, n)``: for each row the other datasets that hold its text, and how often.

        ``df`` is a batch of ``dataset``, indexed or not; entries of that dataset do not count. Rows with a null text
        are in none; rows that share an id are looked up one by one. A text that many rows share is spread.
        """
        rows = df.select(F.col(id_col).alias("_id"), text_key(text).alias("key")).filter(F.col("key").isNotNull())
        counts = cut_lineage(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "keys")
        # Only texts of the batch go on to the rows; both sides hold a key once per dataset.
        held = counts.select("key").join(self.datasets_of(without=dataset), "key")
        rows = rows.withColumn("_row", F.monotonically_increasing_id())
        return join_by_key(rows, held, "key", counts, "inner", ["_row"]).select(F.col("_id").alias(id_col), "dataset", "n")
