"""Distributions of numeric features per group: box summaries and histograms."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.plans.bounded import fits_broadcast, lookup_join
from reviewloom.plans.value_ranks import value_ranks

# Quartiles and the reach of the whiskers.
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
WHISKER = 1.5


def exact_quantiles(ranked: DataFrame, group: str, value: str, probabilities: Mapping[str, float]) -> DataFrame:
    """Interpolated quantiles per group from ``value_ranks``: the two neighbours of each position are
    picked out of the distinct values, so no task holds a group's values."""
    x, below, upto = F.col(value).cast("double"), F.col("below"), F.col("below") + F.col("n")
    aggs: list[Column] = [F.max("total").alias("_rows")]
    parts: list[Column] = []
    for name, p in probabilities.items():
        place = (F.col("total") - 1) * F.lit(p)
        low, high = F.floor(place), F.ceil(place)
        aggs.append(F.max(F.when((below <= low) & (low < upto), x)).alias(f"_lo_{name}"))
        aggs.append(F.max(F.when((below <= high) & (high < upto), x)).alias(f"_hi_{name}"))
        at = (F.col("_rows") - 1) * F.lit(p)
        gap = F.col(f"_hi_{name}") - F.col(f"_lo_{name}")
        parts.append((F.col(f"_lo_{name}") + gap * (at - F.floor(at))).alias(name))
    return ranked.groupBy(group).agg(*aggs).select(group, F.col("_rows").alias("n"), *parts)


def few_groups_in(df: DataFrame, group: str, limit: int = 2_000) -> bool:
    """Are the per-group helper tables small enough to broadcast? One pass over the group column."""
    return fits_broadcast(df.select(group).distinct(), max_rows=limit)


def box_stats(df: DataFrame, group: str, feature: str) -> DataFrame:
    """Quartiles and whiskers without outliers per group, exact.

    Whiskers end at the furthest values within 1.5 interquartile ranges of the box.
    """
    few = few_groups_in(df, group)
    ranked = value_ranks(df, [group], feature, few_keys=few)
    boxes = exact_quantiles(ranked, group, feature, QUARTILES)
    reach = F.lit(WHISKER) * (F.col("q3") - F.col("q1"))
    x = F.col(feature).cast("double")
    held = df.select(group, feature).join(F.broadcast(boxes) if few else boxes, group)
    return held.groupBy(group).agg(
        *[F.max(c).alias(c) for c in ("n", "q1", "median", "q3")],
        F.min(F.when(x >= F.col("q1") - reach, x)).alias("whisker_low"),
        F.max(F.when(x <= F.col("q3") + reach, x)).alias("whisker_high"),
    )


def histogram(df: DataFrame, group: str, feature: str, bins: int = 100) -> DataFrame:
    """Counts in equal-width bins between each group's own minimum and maximum; empty bins are absent.

    Values that are null or not finite are left out. The ranges, one row per group, go to the rows; these are binned
    where they lie and combine there, so no more than ``bins`` counts per group leave a task.
    """
    x = F.col("_x")
    finite = (F.abs(F.col(feature).cast("double")) < float("inf")) & F.col(group).isNotNull()
    rows = df.filter(finite).select(group, F.col(feature).cast("double").alias("_x"))
    ends = rows.groupBy(group).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    slot = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((x - F.col("_lo")) / width), F.lit(bins - 1)).cast("int")
    )
    binned = lookup_join(rows, ends, group, spread_by=["_x"])
    return binned.groupBy(group, slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
