"""Statistical bias audit: do a model's mistakes follow some feature of the text?"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions.text import tokens, word_count
from reviewloom.operators.tables import outcome
from reviewloom.plans.bounded import lookup_join
from reviewloom.plans.value_ranks import value_ranks

ALPHA = 0.05
MIN_ROWS = 3


def text_features(df: DataFrame, id_col: str, text: str, dictionary: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``text_length`` in words, ``sentiment``, distinct ``spelling_mistakes`` and their rate per text.

    The text is tokenised once. All its words (for the sentiment) and its distinct words (for the mistakes) are
    looked up once in the union of both word lists, and become sums per text where they lie: no word is shuffled
    while the lists are small enough to broadcast.
    """
    known = (
        dictionary.select("token", F.lit(1).alias("_known"), F.lit(None).cast("double").alias("_polarity"))
        .unionByName(lexicon.select("token", F.lit(None).cast("int").alias("_known"), F.col("polarity").cast("double").alias("_polarity")))
        .groupBy("token")
        .agg(F.max("_known").alias("_known"), F.max("_polarity").alias("_polarity"))
    )
    counted = df.select(id_col, word_count(text).alias("text_length"), tokens(text).alias("_w"))
    every = F.transform("_w", lambda w: F.struct(w.alias("token"), F.lit(False).alias("_distinct")))
    distinct = F.transform(F.array_distinct("_w"), lambda w: F.struct(w.alias("token"), F.lit(True).alias("_distinct")))
    words = counted.select(id_col, "text_length", F.inline_outer(F.concat(every, distinct)))
    marked = lookup_join(words, known, "token", "left", spread_by=[id_col])
    scored = F.when(~F.col("_distinct"), F.col("_polarity"))
    out = marked.groupBy(id_col, "text_length").agg(
        F.coalesce(F.avg(scored), F.lit(0.0)).alias("sentiment"),
        F.count_if(F.col("_distinct") & F.col("_known").isNull()).alias("spelling_mistakes"),
    )
    rate = F.coalesce(F.try_divide(F.col("spelling_mistakes").cast("double"), F.col("text_length")), F.lit(0.0))
    return out.withColumn("spelling_mistakes_rate", rate)


def moments(df: DataFrame, keys: Sequence[str], side: str, x: str) -> DataFrame:
    """Sizes, means, variances and shape of sides 1 and 2 per key, in one aggregate."""
    v = F.col(x).cast("double")
    aggs = []
    for s in (1, 2):
        own = F.when(F.col(side) == s, v)
        aggs += [
            F.count(own).alias(f"n{s}"),
            F.avg(own).alias(f"mean{s}"),
            F.var_samp(own).alias(f"var{s}"),
            F.skewness(own).alias(f"skew{s}"),
            F.kurtosis(own).alias(f"kurt{s}"),
        ]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def pooled_variance() -> Column:
    n1, n2 = F.col("n1"), F.col("n2")
    return F.try_divide((n1 - 1) * F.col("var1") + (n2 - 1) * F.col("var2"), (n1 + n2 - 2).cast("double"))


def cohens_d_column() -> Column:
    """Difference of means in pooled sample standard deviations."""
    return F.try_divide(F.col("mean1") - F.col("mean2"), F.sqrt(pooled_variance()))


def t_statistic_column() -> Column:
    n1, n2 = F.col("n1"), F.col("n2")
    spread = F.sqrt(pooled_variance() * (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2)))
    return F.try_divide(F.col("mean1") - F.col("mean2"), spread)


def jarque_bera_column(s: int) -> Column:
    """Jarque-Bera statistic of a side, from population skewness and excess kurtosis."""
    skew, kurt = F.col(f"skew{s}"), F.col(f"kurt{s}")
    return F.col(f"n{s}") / F.lit(6.0) * (skew * skew + kurt * kurt / F.lit(4.0))


def normal_column(s: int) -> Column:
    """Is a side compatible with a normal distribution at the 5% level? Fewer than 3 rows never are."""
    p = F.exp(-jarque_bera_column(s) / F.lit(2.0))
    return F.coalesce((F.col(f"n{s}") >= MIN_ROWS) & (p > ALPHA), F.lit(False))


def _sides(df: DataFrame, group: str, first, second, feature: str) -> DataFrame:
    side = F.when(F.col(group) == F.lit(first), 1).when(F.col(group) == F.lit(second), 2)
    return df.select(side.alias("_side"), F.col(feature).alias("_x")).filter(
        F.col("_side").isNotNull() & F.col("_x").isNotNull()
    )


def cohens_d(df: DataFrame, group: str, feature: str, first=1, second=0) -> DataFrame:
    return moments(_sides(df, group, first, second, feature), [], "_side", "_x").select(
        "n1", "n2", "mean1", "mean2", cohens_d_column().alias("cohens_d")
    )


def normality(df: DataFrame, group: str, feature: str) -> DataFrame:
    """Jarque-Bera test of a feature in every group."""
    x = F.col(feature).cast("double")
    out = (
        df.filter(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count(x).alias("n1"), F.skewness(x).alias("skew1"), F.kurtosis(x).alias("kurt1"))
    )
    jb = jarque_bera_column(1)
    return out.select(
        group,
        F.col("n1").alias("n"),
        jb.alias("jarque_bera"),
        F.exp(-jb / F.lit(2.0)).alias("p_value"),
        normal_column(1).alias("is_normal"),
    )


def rank_sums(df: DataFrame, keys: Sequence[str], side: str, x: str, few_keys: bool = True) -> DataFrame:
    """Mann-Whitney ingredients per key: sizes, rank sum of side 1 with mid-ranks, and the tie term."""
    ranked = value_ranks(df, keys, x, {"_n1": F.count_if(F.col(side) == 1)}, few_keys=few_keys)
    n = F.col("n").cast("double")
    mid = F.col("below") + (n + 1) / 2
    return ranked.groupBy(*keys).agg(
        F.sum("_n1").alias("n1"),
        (F.sum("n") - F.sum("_n1")).alias("n2"),
        F.sum(F.col("_n1") * mid).alias("rank_sum"),
        F.sum(n * n * n - n).alias("ties"),
    )


def u_statistic() -> Column:
    n1 = F.col("n1")
    return F.col("rank_sum") - n1 * (n1 + 1) / F.lit(2.0)


def mann_whitney_z() -> Column:
    """Continuity- and tie-corrected normal score of the U test."""
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    u = F.greatest(u_statistic(), n1 * n2 - u_statistic())
    sd = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - F.try_divide(F.col("ties"), n * (n - 1))))
    return F.try_divide(u - n1 * n2 / 2.0 - 0.5, sd)


@F.pandas_udf(T.DoubleType())
def two_sided_normal_p(z: pd.Series) -> pd.Series:
    """P(|Z| >= z) for a handful of test results; the JVM has no error function."""
    return z.map(lambda v: None if pd.isna(v) else min(1.0, math.erfc(v / math.sqrt(2.0))))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (Lentz's method)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-14:
            break
    return h


def student_t_p(t: float, dof: float) -> float:
    """Two-sided p-value of Student's t."""
    x = dof / (dof + t * t)
    a, b = dof / 2.0, 0.5
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


@F.pandas_udf(T.DoubleType())
def two_sided_t_p(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series(
        [None if pd.isna(v) or pd.isna(d) or d <= 0 else student_t_p(float(v), float(d)) for v, d in zip(t, dof)],
        dtype="float64",
    )


def mann_whitney(df: DataFrame, group: str, feature: str, first=1, second=0) -> DataFrame:
    """U statistic of the first group, its two-sided p-value and the 5% verdict.

    The p-value is the tie- and continuity-corrected normal approximation at every sample size.
    """
    sides = _sides(df, group, first, second, feature).withColumn("_all", F.lit(0))
    sums = rank_sums(sides, ["_all"], "_side", "_x")
    return sums.select(
        "n1",
        "n2",
        u_statistic().alias("u"),
        two_sided_normal_p(mann_whitney_z()).alias("p_value"),
    ).withColumn("significant", F.col("p_value") < ALPHA)


def t_test(df: DataFrame, group: str, feature: str, first=1, second=0) -> DataFrame:
    """Pooled two-sample t test; statistic and p-value are null unless both groups look normal."""
    m = moments(_sides(df, group, first, second, feature), [], "_side", "_x")
    both = normal_column(1) & normal_column(2)
    return m.select(
        "n1", "n2", both.alias("both_normal"), t_statistic_column().alias("t"), F.when(both, t_statistic_column()).alias("t_if_normal")
    ).withColumn("p_value", two_sided_t_p("t_if_normal", (F.col("n1") + F.col("n2") - 2).cast("double")))


# The comparisons of the audit and the outcomes on either side.
COMPARISONS: Mapping[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "correct_vs_incorrect": (("TP", "TN"), ("FP", "FN", "Unknown")),
    "tp_vs_fn": (("TP",), ("FN",)),
    "tn_vs_fp": (("TN",), ("FP",)),
}


def stack_comparisons(df: DataFrame, features: Sequence[str], y: str, p: str) -> DataFrame:
    """Each row once per feature and comparison it takes part in: ``(feature, comparison, side, x)``."""
    group = F.col("_group")
    sides = [
        F.struct(
            F.lit(name).alias("comparison"),
            F.when(group.isin(*one), 1).when(group.isin(*two), 2).alias("side"),
        )
        for name, (one, two) in COMPARISONS.items()
    ]
    values = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features]
    return (
        df.select(outcome(y, p).alias("_group"), *features)
        .select(F.explode(F.array(*values)).alias("_v"), F.array(*sides).alias("_s"))
        .select("_v.*", F.explode("_s").alias("_s"))
        .select("feature", "x", "_s.*")
        .filter(F.col("side").isNotNull() & F.col("x").isNotNull())
    )


def bias_statistics(df: DataFrame, features: Sequence[str], y: str, p: str) -> DataFrame:
    """Effect size, U, t and normality for every feature and comparison, in one job.

    The stacked rows shrink to distinct values per (feature, comparison) before anything is ranked.
    """
    stacked = stack_comparisons(df, features, y, p)
    keys = ["feature", "comparison"]
    m = moments(stacked, keys, "side", "x")
    ranks = rank_sums(stacked, keys, "side", "x").drop("n1", "n2")
    both = m.join(F.broadcast(ranks), keys)  # one row per feature and comparison
    normal = normal_column(1) & normal_column(2)
    return both.select(
        *keys,
        "n1",
        "n2",
        cohens_d_column().alias("cohens_d"),
        u_statistic().alias("u"),
        mann_whitney_z().alias("z"),
        normal.alias("both_normal"),
        F.when(normal, t_statistic_column()).alias("t"),
    )


def bias_audit(df: DataFrame, features: Sequence[str], y: str, p: str) -> DataFrame:
    """``bias_statistics`` with p-values and a verdict at the 5% level."""
    stats = bias_statistics(df, features, y, p)
    out = stats.withColumn("mann_whitney_p", two_sided_normal_p("z")).withColumn(
        "t_p", two_sided_t_p("t", (F.col("n1") + F.col("n2") - 2).cast("double"))
    )
    verdict = F.when(F.col("mann_whitney_p") < ALPHA, "significant difference").otherwise("no significant difference")
    return out.withColumn("verdict", verdict)
