"""Splitting, balancing, sampling and mixing, all by seeded hash order."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.hashing import DEFAULT_SEED, seed_hash, uniform
from reviewloom.operators.tables import concat_datasets
from reviewloom.plans.hash_rank import TooManyGroups, hash_segments, rank_by_hash, take_by_hash

# Default shares of train, test and validation rows.
SPLIT_FRACTIONS = {"train": 0.5, "test": 0.25, "val": 0.25}


def assign_splits(df: DataFrame, id_col: str, fractions: Mapping[str, float] | None = None, seed: int = DEFAULT_SEED) -> DataFrame:
    """One-hot split columns; a row's split depends on its id alone, so it survives new data."""
    fractions = dict(fractions or SPLIT_FRACTIONS)
    total = sum(fractions.values())
    if not math.isclose(total, 1.0, rel_tol=1e-5, abs_tol=1e-8):
        raise ValueError(f"split fractions must add up to 1, got {total}")
    u = uniform(seed, id_col)
    names, lower, flags = list(fractions), 0.0, {}
    for i, name in enumerate(names):
        upper = lower + fractions[name]
        inside = u >= F.lit(lower) if i == len(names) - 1 else (u >= F.lit(lower)) & (u < F.lit(upper))
        flags[name] = inside.cast("int")
        lower = upper
    return df.withColumns(flags)


def balance(df: DataFrame, y: str, id_col: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """Down-sample every class to the size of the smallest; rows without a label are left out."""

    def smallest(sizes: dict) -> dict:
        return {g: min(sizes.values()) for g in sizes}

    return take_by_hash(df, y, id_col, smallest, seed, many_groups_quota=F.col("_min"))


def shuffle(df: DataFrame, id_col: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """Rows in a reproducible random order. Only an export needs this; row order means nothing in Spark."""
    return df.orderBy(seed_hash(seed, id_col), id_col)


def shuffle_positions(df: DataFrame, id_col: str, seed: int = DEFAULT_SEED, name: str = "position") -> DataFrame:
    """Every row with its place (from 1) in the order of ``shuffle``, for exports that are written in parts.

    No global sort: rows meet by their leading hash digits, and counts per digits tell where each part begins. Rows
    that share a key share its first place; rows without a key are left out.
    """
    return rank_by_hash(df.withColumn("_all", F.lit(0)), "_all", id_col, seed, name).drop("_all", "_n")


def sample_n(df: DataFrame, n: int, id_col: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """The first n rows in hash order (all of them when there are fewer), and rows that share the last one's key.

    Rows without a key are left out.
    """
    return take_by_hash(df, None, id_col, n, seed)


def mix(df: DataFrame, source: str, recipe: Mapping[str, int | str], id_col: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """Rows of a multi-source table by recipe: ``'all'`` or a number per source; others are dropped."""
    whole = [s for s, n in recipe.items() if n == "all"]
    part = {s: int(n) for s, n in recipe.items() if n != "all"}
    everything = df.filter(F.col(source).isin(whole)) if whole else None
    if not part:
        return everything
    some = take_by_hash(df.filter(F.col(source).isin(list(part))), source, id_col, part, seed)
    return some if everything is None else everything.unionByName(some)


def mix_datasets(dfs: Mapping[str, DataFrame], recipe: Mapping[str, int | str], id_col: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """``mix`` over separate datasets, stacked with a ``source`` column."""
    chosen = {name: dfs[name] for name in recipe}
    return mix(concat_datasets(chosen, source_col="source"), "source", recipe, id_col, seed)


def carve(
    df: DataFrame, y: str, id_col: str, validation: int, supplementary: int, seed: int = DEFAULT_SEED
) -> DataFrame:
    """Disjoint sets out of one binary-labelled pool, as a ``part`` column.

    Positives: half of the validation set, the rest for training. Negatives, in this order: the
    supplementary set, as many for training as there are positives, the other half of the validation
    set, and what remains widens it. ``in_big_validation`` marks validation plus that remainder.
    """
    half = validation // 2

    def cutoffs(sizes: dict) -> dict:
        left = max(sizes.get(1, 0) - half, 0)
        return {1: [half], 0: [supplementary, supplementary + left, supplementary + left + half]}

    part = (
        F.when((F.col(y) == 1) & (F.col("_seg") == 0), "validation")
        .when(F.col(y) == 1, "train")
        .when(F.col("_seg") == 0, "supplementary")
        .when(F.col("_seg") == 1, "train")
        .when(F.col("_seg") == 2, "validation")
        .otherwise("remainder")
    )
    return (
        hash_segments(df.filter(F.col(y).isin(0, 1)), y, id_col, cutoffs, seed, "_seg")
        .withColumn("part", part)
        .withColumn("in_big_validation", F.col("part").isin("validation", "remainder"))
        .drop("_seg")
    )


def holdout(df: DataFrame, y: str, id_col: str, size: int, balance_rest: bool = False, seed: int = DEFAULT_SEED) -> DataFrame:
    """Balanced hold-out of ``size`` rows from a binary-labelled pool, as a ``part`` column.

    The rest is ``train``; with ``balance_rest`` negatives beyond the number of remaining positives are
    ``unused``.
    """
    half = size // 2

    def cutoffs(sizes: dict) -> dict:
        left = max(sizes.get(1, 0) - half, 0)
        return {1: [half], 0: [half, half + left] if balance_rest else [half]}

    names = F.when(F.col("_seg") == 0, "validation").when(F.col("_seg") == 1, "train").otherwise("unused")
    pool = df.filter(F.col(y).isin(0, 1))
    return hash_segments(pool, y, id_col, cutoffs, seed, "_seg").withColumn("part", names).drop("_seg")


def stratified_split(df: DataFrame, y: str, id_col: str, fraction: float = 0.2, seed: int = DEFAULT_SEED) -> DataFrame:
    """``is_val`` = 1 for exactly the rounded fraction of every class."""

    def cutoffs(sizes: dict) -> dict:
        return {g: [math.floor(fraction * n + 0.5)] for g, n in sizes.items()}

    try:
        placed = hash_segments(df, y, id_col, cutoffs, seed, "_seg").withColumn("_val", F.col("_seg") == 0)
    except TooManyGroups:
        ranked = rank_by_hash(df, y, id_col, seed, "_rank")
        placed = ranked.withColumn("_val", F.col("_rank") <= F.floor(F.lit(fraction) * F.col("_n") + F.lit(0.5)))
    return placed.select(*df.columns, F.col("_val").cast("int").alias("is_val"))


def evaluation_sets(
    datasets: Sequence[DataFrame],
    y: str,
    id_col: str,
    balance_test: bool = True,
    balance_val: bool = True,
    seed: int = DEFAULT_SEED,
) -> dict[str, DataFrame]:
    """Test and validation rows of all datasets together, each optionally balanced."""
    pool = concat_datasets(datasets)
    out = {}
    for name, balanced in (("test", balance_test), ("val", balance_val)):
        rows = pool.filter(F.col(name) == 1)
        out[name] = balance(rows, y, id_col, seed) if balanced else rows
    return out
