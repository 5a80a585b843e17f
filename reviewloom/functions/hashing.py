"""Deterministic randomness.

Every draw, shuffle and sample in this package is a function of a seed and of the row's own key, so a
result does not depend on partitioning, on task retries or on the order in which files are read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SEED = 42


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seed_hash(seed: int | str, *keys: Column | str) -> Column:
    """md5 of ``seed|key|key...`` as 32 lower-case hex digits."""
    parts = [_col(k).cast("string") for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def hash_to_unit(hex_hash: Column) -> Column:
    """First 32 bits of a hex hash as a double in [0, 1)."""
    return F.conv(F.substring(hex_hash, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def uniform(seed: int | str, *keys: Column | str) -> Column:
    """Uniform draw in [0, 1) fixed by the seed and the keys."""
    return hash_to_unit(seed_hash(seed, *keys))


def text_key(text: Column | str) -> Column:
    """Fixed-width stand-in for a long text in shuffles; null stays null."""
    return F.unhex(F.sha2(_col(text).cast("string"), 256))
