"""Broadcast only what is known to be small; join by shuffle, with salt, when it is not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from reviewloom.plans.session import cut_lineage

MAX_ROWS = 500_000
MAX_BYTES = 64 * 1024 * 1024
SALTS = 32
HOT_KEYS = 1_000
SMALL_SPLITS, SPREAD_TASKS = 8, 64


def bounded_rows(df: DataFrame, limit: int) -> list[Row] | None:
    """All rows when there are at most ``limit`` of them, else None. Never fetches more than that."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def fits_broadcast(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """Measure a frame (one aggregate) and tell whether it may be sent to every executor."""
    width = sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns), F.lit(0))
    size = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(width.cast("bigint")).alias("bytes")).first()
    return size["rows"] <= max_rows and (size["bytes"] or 0) <= max_bytes


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: str,
    how: str = "inner",
    spread_by: Sequence[str] = (),
    max_rows: int = MAX_ROWS,
    fits: bool | None = None,
) -> DataFrame:
    """Join a large frame to a dictionary on one key, whatever the key's skew.

    A dictionary that passes the size check is broadcast, so the large side does not move. A larger one
    is repeated once per salt and joined on (key, salt), so a key holding a third of all rows is spread
    over ``SALTS`` tasks. ``spread_by`` names columns that vary within a hot key. ``fits`` tells the result of a
    size check that was made before; otherwise the dictionary is written to the shared folder, measured there and
    read from there, so whatever made it runs once.
    """
    if fits is None:
        small = cut_lineage(small, "dictionary")
        fits = fits_broadcast(small, max_rows=max_rows)
    if fits:
        return big.join(F.broadcast(small), on, how)
    salted_big = big.withColumn("_salt", F.pmod(F.xxhash64(*(spread_by or big.columns)), F.lit(SALTS)))
    salted_small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return salted_big.join(salted_small, [on, "_salt"], how).drop("_salt")


def join_by_key(big: DataFrame, small: DataFrame, key: str, counts: DataFrame, how: str, spread_by: Sequence[str]) -> DataFrame:
    """Join a large frame to one that is large too, whatever the key's skew in ``big``.

    ``counts`` holds ``(key, n)`` of ``big``, stored. A key with more than 1 in ``HOT_KEYS`` of its rows is hot, so
    there are fewer than ``HOT_KEYS`` of them: these alone are spread over ``SALTS`` tasks and repeated in ``small``.
    Null keys are spread as well. ``spread_by`` names columns that vary within a hot key.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(counts.filter(F.col("n") * HOT_KEYS > total).select(key, F.lit(True).alias("_hot")))
    last = F.lit(SALTS - 1).cast("bigint")
    draw, none = F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)), F.lit(0).cast("bigint")
    dealt = big.join(hot, key, "left").withColumn("_salt", F.when(F.col("_hot") | F.col(key).isNull(), draw).otherwise(none)).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(none, last)).otherwise(F.array(none))
    repeated = small.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return dealt.join(repeated, [key, "_salt"], how).drop("_salt")


def spread_small(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a table of a few splits over the cores, by key.

    For a table read as it is and about to meet CPU-heavy expressions. One of more than ``SMALL_SPLITS`` splits,
    about 1 GB, does not move on any cluster.
    """
    cores = min(df.sparkSession.sparkContext.defaultParallelism, SPREAD_TASKS)
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < min(cores, SMALL_SPLITS) else df
