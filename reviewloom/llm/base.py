"""What the operators share: registration, reading, schemas, and byte-level word hashing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None):
    """Register a function ``(spark, folder) -> DataFrame`` under a name."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def n_words(text: str) -> Column:
    """Number of words of a text column; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def free_name(columns: list[str], wanted: str) -> str:
    """A column name that none of ``columns`` has, whatever their case."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one slice holds about ``most`` bytes of a text column, or a single row."""
    for batch in batches:
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64)
        part = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)


_RNG = np.random.default_rng(20240611)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all bits depend on all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2**64."""
    with np.errstate(over="ignore"):
        up = np.full(max(n, 1), _BASE, np.uint64)
        up[0] = 1
        down = np.full(max(n, 1), pow(_BASE, -1, 2**64), np.uint64)
        down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def prefix_hash(data: np.ndarray, up: np.ndarray) -> np.ndarray:
    """``out[i]`` covers the first i bytes; a substring's hash follows from two entries by :func:`span_hash`."""
    with np.errstate(over="ignore"):
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=out[1:])
        return out


def span_hash(prefix: np.ndarray, down: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes from start to end, by content alone."""
    with np.errstate(over="ignore"):
        return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hash of each word of lower-cased bytes, in order.

    Words get a hash of their own: with a polynomial modulo 2**64 there are long words that collide for every base.
    """
    words = text.split()  # at 0x20 and 0x09 to 0x0D
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of a text's n-word shingles; a shorter text is one shingle, no words are none."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    words = word_hashes(raw)
    if not len(words):
        return words
    width = min(n, len(words))
    with np.errstate(over="ignore"):
        out = np.full(len(words) - width + 1, width, np.uint64)
        for k in range(width):
            out = mix(out ^ words[k : k + len(out)]) * np.uint64(_BASE)
        return np.unique(mix(out))


_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def known_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`powers`, kept per worker up to a million."""
    if n > 1 << 20:
        return powers(n)
    if not _POWERS:
        _POWERS.append(powers(1 << 20))
    return _POWERS[0]
