"""Registration of queries and the pieces of SQL that several of them share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions.text import WHITESPACE
from reviewloom.plans.bounded import spread_small

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function ``(spark, folder) -> DataFrame`` under a name, with its SQL twin."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str, spread: str | None = None) -> DataFrame:
    """A test table; with ``spread``, one that is too small to occupy all cores is spread by that key."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread_small(df, spread) if spread else df


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents", spread="doc_id")


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that carry labels: ``toxic`` is the label, ``flagged_p`` (quality = 0) the prediction."""
    labels = table(spark, folder, "labels").withColumn("flagged_p", (F.col("quality") == 0).cast("int"))
    return documents(spark, folder).join(labels, "doc_id")


REVIEWS = """(select d.*, l.quality, l.toxic, case when l.quality = 0 then 1 else 0 end as flagged_p
  from documents d join labels l on d.doc_id = l.doc_id)"""


def unit(*keys: str, seed: int = 42) -> str:
    """SQL of a uniform draw by hash."""
    args = ", ".join(f"cast({k} as varchar)" for k in keys)
    return f"(('0x' || substr(md5(concat_ws('|', '{seed}', {args})), 1, 8))::bigint / 4294967296::double)"


def by_hash(key: str, seed: int = 42) -> str:
    """SQL of the hash order."""
    return f"md5(concat_ws('|', '{seed}', cast({key} as varchar))), {key}"


STRIP = rf"^[{WHITESPACE}]+|[{WHITESPACE}]+\z"


def strip_sql(text: str) -> str:
    return rf"regexp_replace({text}, '{STRIP}', '', 'g')"


def clean_sql(text: str) -> str:
    steps = strip_sql(text)
    for old in ("  ", "   "):
        steps = f"regexp_replace({steps}, '{old}', ' ', 'g')"
    return rf"lower(regexp_replace({steps}, '\n', '', 'g'))"


def words_sql(text: str) -> str:
    return rf"regexp_extract_all(lower({text}), '\p{{L}}+')"


def sentences_sql(text: str) -> str:
    return rf"list_filter(string_split({text}, '.'), lambda s: regexp_matches(s, '[^{WHITESPACE}]'))"
