"""A training corpus from raw documents: drop toxic texts, near duplicates and benchmark leaks, mix sources, shard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewloom.llm.base import table
from reviewloom.llm.contamination import decontaminate
from reviewloom.llm.mixing import draw
from reviewloom.llm.neardup import drop_near_duplicates
from reviewloom.llm.shards import assign_shards
from reviewloom.llm.toxicity import drop_toxic
from reviewloom.plans.session import cut_lineage

SHARDS = 40


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at 0.8."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, each as often as it takes it (twice at most)."""
    return draw(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and the place in it of every row of the mix."""
    return assign_shards(docs, SHARDS)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: SQL can express neither learned scores nor MinHash; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
