"""Tests by distributed ranks: normality by Shapiro-Francia, and Mann-Whitney with its exact small-group distribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.operators.bias import ALPHA, mann_whitney_z, rank_sums, two_sided_normal_p, u_statistic
from reviewloom.plans.bounded import lookup_join
from reviewloom.plans.value_ranks import value_ranks

#: The exact distribution serves where the smaller group has at most so many rows, and U so many values.
EXACT_ROWS, EXACT_VALUES = 8, 2_000

# The rational approximation of the normal quantile function (central part and tail, numerators and
# denominators from the highest power down), good to nine digits.
_CENTRE = (
    (-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.3577518672690, -30.66479806614716, 2.506628277459239),
    (-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572, 1.0),
)
_TAIL = (
    (-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783),
    (0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416, 1.0),
)
_TAIL_FROM = 0.02425

# Mean and spread of ln(1 - W') under normality, by ln(n) and ln(ln(n)), for 5 to 5,000 rows.
_W_MEAN, _W_SPREAD, _W_ROWS = (-1.2725, 1.0521), (1.0308, -0.26758), (5, 5_000)


def _ratio(parts: tuple[tuple[float, ...], tuple[float, ...]], x: Column) -> Column:
    def horner(terms: Sequence[float]) -> Column:
        out = F.lit(terms[0])
        for t in terms[1:]:
            out = out * x + F.lit(t)
        return out

    return horner(parts[0]) / horner(parts[1])


def normal_quantile(p: Column) -> Column:
    """The normal score below which a share ``p`` (strictly between 0 and 1) lies, in the JVM."""
    low = F.least(p, F.lit(1.0) - p)
    centre = p - F.lit(0.5)
    tail = _ratio(_TAIL, F.sqrt(F.lit(-2.0) * F.ln(low)))
    return F.when(low >= _TAIL_FROM, centre * _ratio(_CENTRE, centre * centre)).otherwise(F.when(centre < 0, tail).otherwise(-tail))


def shapiro_francia(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, n, w, z, p_value, is_normal) of every group: how straight its values lie against normal scores.

    W' is the squared correlation of the values with the normal scores of their mid-ranks, so a tie is one value with
    a weight. Ranks come from :func:`value_ranks`: no group is sorted as a whole, and of a group only distinct values
    move. Values are taken from the group's mean before they are squared. ``z`` and ``p_value`` are null outside 5 to
    5,000 rows, where the distribution of W' is not tabulated; ``w`` is null for fewer than 3 rows or one value. Null
    and non-finite values and rows without a key are left out.
    """
    x = F.col(value).cast("double")
    rows = df.select(*keys, x.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v") & (F.abs("_v") < F.lit(float("inf"))))
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    ranked = value_ranks(rows, keys, "_v")
    rank = F.col("below") + (F.col("n") + 1) / 2
    scored = ranked.withColumn("_m", normal_quantile((rank - 0.375) / (F.col("total") + 0.25)))
    if keys:
        scored = scored.withColumn("_k", F.struct(*keys))
        means = rows.groupBy(*keys).agg(F.avg("_v").alias("_mean")).select(F.struct(*keys).alias("_k"), "_mean")
        scored = lookup_join(scored, means, "_k", spread_by=["_v"]).drop("_k")
    else:
        scored = scored.withColumn("_mean", rows.agg(F.avg("_v")).scalar())
    d, m, n = F.col("_v") - F.col("_mean"), F.col("_m"), F.col("n")
    sums = {"xx": n * d * d, "mm": n * m * m, "xm": n * d * m, "x": n * d, "m": n * m}
    out = scored.groupBy(*keys).agg(F.sum("n").alias("n"), *(F.sum(c).alias(f"_{name}") for name, c in sums.items()))
    centred = lambda a, b, c: F.col(f"_{a}") - F.col(f"_{b}") * F.col(f"_{c}") / F.col("n")
    xx, mm, xm = centred("xx", "x", "x"), centred("mm", "m", "m"), centred("xm", "x", "m")
    out = out.withColumn("w", F.when((F.col("n") >= 3) & (xx > 0) & (mm > 0), F.least(F.lit(1.0), xm * xm / (xx * mm))))
    u = F.ln(F.col("n").cast("double"))
    mean = F.lit(_W_MEAN[0]) + F.lit(_W_MEAN[1]) * (F.ln(u) - u)
    spread = F.lit(_W_SPREAD[0]) + F.lit(_W_SPREAD[1]) * (F.ln(u) + F.lit(2.0) / u)
    z = F.when(F.col("n").between(*_W_ROWS) & (F.col("w") < 1), (F.ln(F.lit(1.0) - F.col("w")) - mean) / spread)
    out = out.withColumn("z", z)
    # One-sided: only a low W', a high z, speaks against normality.
    two = two_sided_normal_p(F.abs("z"))
    out = out.withColumn("_p", two).withColumn("p_value", F.when(F.col("z") > 0, F.col("_p") / 2).otherwise(F.lit(1.0) - F.col("_p") / 2))
    return out.select(*keys, "n", "w", "z", "p_value", (F.col("p_value") > ALPHA).alias("is_normal"))


def rank_sum_ways(few: Column, all_rows: Column) -> Column:
    """How often each U from 0 up occurs among all choices of ``few`` ranks out of ``all_rows``.

    The ranks 1, 2, ... are offered one after another, and each choice takes the rank or not: an array fold over a
    table of (ranks taken, their sum). No rank is looked at twice, and nothing leaves the row.
    """
    width = few * (all_rows - few) + 1  # sums are kept as U, the sum beyond 1 + 2 + ... + taken
    none = F.array_repeat(F.lit(0.0), width.cast("int"))
    first = F.transform(none, lambda _, s: F.when(s == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    start = F.transform(F.sequence(F.lit(0), few.cast("int")), lambda j: F.when(j == 0, first).otherwise(none))

    def offer(table: Column, rank: Column) -> Column:
        # The j-th rank taken adds rank - j to U.
        def row(own: Column, j: Column) -> Column:
            less = F.get(table, j - 1)
            return F.transform(own, lambda v, s: v + F.coalesce(F.when(s >= rank - j, F.get(less, s - (rank - j))), F.lit(0.0)))

        return F.transform(table, lambda own, j: F.when((j == 0) | (j > rank), own).otherwise(row(own, j)))

    return F.element_at(F.aggregate(F.sequence(F.lit(1), all_rows.cast("int")), start, offer), -1)


def exact_mann_whitney_p(n1: Column, n2: Column, u: Column) -> Column:
    """Two-sided p-value of U when all choices of ranks are equally likely and no values tie."""
    ways = rank_sum_ways(F.least(n1, n2), n1 + n2)
    far = F.greatest(u, n1 * n2 - u)
    total = F.aggregate(ways, F.lit(0.0), lambda a, v: a + v)
    beyond = F.aggregate(F.slice(ways, far.cast("int") + 1, F.size(ways)), F.lit(0.0), lambda a, v: a + v)
    return F.least(F.lit(1.0), F.lit(2.0) * beyond / total)


def mann_whitney_by(df: DataFrame, keys: Sequence[str], group: str, feature: str, first=1, second=0) -> DataFrame:
    """(keys, n1, n2, u, exact, p_value, significant) of every combination of keys with rows on both sides.

    Without ties and with at most ``EXACT_ROWS`` rows on the smaller side (and ``EXACT_VALUES`` values of U) the p-value
    is exact; else it is the tie- and continuity-corrected normal approximation.
    """
    side = F.when(F.col(group) == F.lit(first), 1).when(F.col(group) == F.lit(second), 2)
    rows = df.select(*keys, side.alias("_side"), F.col(feature).alias("_x")).where(F.col("_side").isNotNull() & F.col("_x").isNotNull())
    sums = rank_sums(rows, keys, "_side", "_x", few_keys=False).where((F.col("n1") > 0) & (F.col("n2") > 0))
    exact = (F.col("ties") == 0) & (F.least("n1", "n2") <= EXACT_ROWS) & (F.col("n1") * F.col("n2") <= EXACT_VALUES)
    out = sums.withColumn("u", u_statistic()).withColumn("exact", exact).withColumn("_z", two_sided_normal_p(mann_whitney_z()))
    p = F.when(F.col("exact"), exact_mann_whitney_p(F.col("n1"), F.col("n2"), F.col("u"))).otherwise(F.col("_z"))
    return out.select(*keys, "n1", "n2", "u", "exact", p.alias("p_value")).withColumn("significant", F.col("p_value") < ALPHA)
