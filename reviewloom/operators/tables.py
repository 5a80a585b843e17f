"""Shaping labelled review tables: union, labels, schema harmonising, filters and timelines."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions.scores import lookup

SPLITS = ("train", "test", "val")


def concat_datasets(
    dfs: Sequence[DataFrame] | Mapping[str, DataFrame], how: str = "outer", source_col: str | None = None
) -> DataFrame:
    """Stack datasets by column name.

    ``outer`` keeps every column and fills the gaps with null, ``inner`` keeps the shared columns. With a
    mapping and ``source_col`` each row also carries the name of the dataset it came from.
    """
    if isinstance(dfs, Mapping):
        frames = [df.withColumn(source_col, F.lit(name)) if source_col else df for name, df in dfs.items()]
    else:
        frames = list(dfs)
    if not frames:
        raise ValueError("nothing to concatenate")
    if how == "inner":
        shared = [c for c in frames[0].columns if all(c in f.columns for f in frames[1:])]
        frames = [f.select(*shared) for f in frames]
    elif how != "outer":
        raise ValueError(f"unknown concat mode: {how}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_label(df: DataFrame, col: str, value) -> DataFrame:
    """Give a whole dataset one label."""
    return df.withColumn(col, F.lit(value))


def harmonise(df: DataFrame, rename: Mapping[str, str], keep: Sequence[str], drop_null: bool = False) -> DataFrame:
    """Rename, keep the chosen columns, and optionally drop rows with a null in any of them."""
    out = df.withColumnsRenamed(dict(rename)).select(*keep)
    return out.na.drop() if drop_null else out


def drop_null_text(df: DataFrame, col: str) -> DataFrame:
    return df.na.drop(subset=[col])


def split_slice(df: DataFrame, which: str | Sequence[str]) -> DataFrame:
    """Rows of one split, of any of several splits, or all rows for ``all``."""
    if which == "all":
        return df
    names = [which] if isinstance(which, str) else list(which)
    unknown = set(names) - set(SPLITS)
    if unknown:
        raise ValueError(f"unknown split: {sorted(unknown)}")
    return df.filter(reduce(lambda a, b: a | b, [F.col(n) == 1 for n in names]))


def exclude_keywords(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """Drop rows whose text mentions the pattern (case-sensitive); rows without text go too."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).rlike(pattern))


def drop_status(df: DataFrame, col: str, value: str) -> DataFrame:
    """Drop rows with this status; rows without a status stay."""
    return df.filter(~F.col(col).eqNullSafe(F.lit(value)))


def wall_clock(text: Column | str) -> Column:
    """Timestamp without zone from text: an offset is ignored, an unreadable date becomes null."""
    c = F.col(text) if isinstance(text, str) else text
    return c.cast("string").try_cast(T.TimestampNTZType())


def fix_timeline(df: DataFrame, col: str, sort: bool = True) -> DataFrame:
    """Normalise a date column and put the newest rows first, unreadable dates last.

    Rows of one date, or without one, are further ordered by a hash of the row. Their order means nothing,
    but it lets the sort cut a date that holds a third of the table into many ranges.
    """
    out = df.withColumn(col, wall_clock(col))
    if not sort:
        return out
    rest = [f.name for f in out.schema.fields if f.name != col and "map<" not in f.dataType.simpleString()]
    spread = [F.xxhash64(*rest)] if rest else []
    return out.orderBy(F.col(col).desc_nulls_last(), *spread)


def map_label(df: DataFrame, col: str, mapping: Mapping, out: str | None = None) -> DataFrame:
    """Translate labels by dictionary; a label that is not in it becomes null."""
    return df.withColumn(out or col, lookup(col, mapping))


def unpack_prediction(df: DataFrame, col: str, fields: Mapping[str, str]) -> DataFrame:
    """Fields of a struct prediction as columns: ``{struct field: column name}``."""
    return df.withColumns({name: F.col(col)[field] for field, name in fields.items()})


def binarise(df: DataFrame, col: str, positives: Iterable, out: str | None = None) -> DataFrame:
    """1 for the listed classes, 0 for everything else, null included."""
    return df.withColumn(out or col, F.when(F.col(col).isin(list(positives)), 1).otherwise(0))


def outcome(y: Column | str, p: Column | str) -> Column:
    """TP / TN / FP / FN, or Unknown when label or prediction is neither 0 nor 1."""
    y = F.col(y) if isinstance(y, str) else y
    p = F.col(p) if isinstance(p, str) else p
    return (
        F.when((y == 1) & (p == 1), "TP")
        .when((y == 0) & (p == 0), "TN")
        .when((y == 0) & (p == 1), "FP")
        .when((y == 1) & (p == 0), "FN")
        .otherwise("Unknown")
    )


def classification_group(df: DataFrame, y: str, p: str) -> DataFrame:
    """Add ``classification_group`` and ``correct`` columns."""
    return df.withColumn("classification_group", outcome(y, p)).withColumn(
        "correct", F.col("classification_group").isin("TP", "TN")
    )
