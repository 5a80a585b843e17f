"""Ranks of values without one big sort.

Rows are first reduced to distinct values with counts (map-side combined, so ties cost nothing), the
distinct values are cut into ranges of about equal size, and the running count is taken inside each range
and shifted by the ranges below. No task sees more than one range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.plans.bounded import fits_broadcast

MIN_RANGES, MAX_RANGES = 16, 512


def range_count(df: DataFrame) -> int:
    """Twice as many ranges as shuffle partitions, so that a few heavy ones even out."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(MIN_RANGES, min(MAX_RANGES, 2 * partitions))


def value_ranks(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    sums: Mapping[str, Column] | None = None,
    few_keys: bool = False,
) -> DataFrame:
    """Per key and distinct non-null value: ``n`` rows, ``below`` rows with a smaller value, the ``total`` of
    the key, and ``sums``.

    ``few_keys`` says that the caller fixes the number of key combinations, so the range table (one row
    per combination) may be broadcast unseen; otherwise its size is checked first.
    """
    keys = list(keys)
    extra = [c.alias(name) for name, c in (sums or {}).items()]
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("_x"))
        .agg(F.count(F.lit(1)).alias("n"), *extra)
    )
    ranges = range_count(df)
    probabilities = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    small = few_keys or fits_broadcast(df.select(*keys).distinct(), max_rows=2_000)
    hint = F.broadcast if small else (lambda d: d)
    # Both helper tables touch every column of `counted`, so that all branches ask for the same exchange
    # and the source is read and shuffled once.
    touched = [F.max(c).alias(f"_t_{c}") for c in ["n", *(sums or {})]]
    in_use = F.coalesce(*[F.col(f"_t_{c}").cast("double") for c in [*(sums or {}), "n"]]).isNotNull()
    bounds = (
        counted.groupBy(*keys)
        .agg(F.percentile_approx("_x", probabilities, F.lit(2000)).alias("_bounds"), *touched)
        .filter(in_use)
        .select(*keys, "_bounds")
    )
    ranged = counted.join(hint(bounds), keys).withColumn(
        "_range", F.size(F.filter("_bounds", lambda b: b < F.col("_x")))
    ).drop("_bounds")
    lower = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(*keys, "_range")
        .agg(F.sum("n").alias("_rows"), *touched)
        .filter(in_use)
        .select(
            *keys,
            "_range",
            F.coalesce(F.sum("_rows").over(lower), F.lit(0)).alias("_start"),
            F.sum("_rows").over(Window.partitionBy(*keys)).alias("total"),
        )
    )
    inside = Window.partitionBy(*keys, "_range").orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ranged.join(hint(starts), [*keys, "_range"])
        .withColumn("below", F.col("_start") + F.sum("n").over(inside) - F.col("n"))
        .drop("_range", "_start")
        .withColumnRenamed("_x", value)
    )
