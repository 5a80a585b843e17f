"""Classification metrics, each from one pass of conditional counts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Classes whose k x k cells are laid out from one row.
MAX_CLASSES = 2_000


def _ratio(num: Column, den: Column, undefined: float | None = 0.0) -> Column:
    filler = F.lit(undefined) if undefined is not None else F.lit(None).cast("double")
    return F.when(den == 0, filler).otherwise(num.cast("double") / den)


def binary_counts(y: str, p: str) -> dict[str, Column]:
    """Aggregates TN, FP, FN, TP over rows that have both a label and a prediction."""
    y_, p_ = F.col(y), F.col(p)
    return {
        "tn": F.count_if((y_ == 0) & (p_ == 0)),
        "fp": F.count_if((y_ == 0) & (p_ == 1)),
        "fn": F.count_if((y_ == 1) & (p_ == 0)),
        "tp": F.count_if((y_ == 1) & (p_ == 1)),
    }


def _counted(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    aggs = [c.alias(n) for n, c in binary_counts(y, p).items()]
    aggs.append(F.count(F.col(p)).alias("_predicted"))
    return (df.groupBy(*by) if by else df).agg(*aggs)


def confusion(df: DataFrame, y: str, p: str, zero_cells: bool = True) -> DataFrame:
    """k x k confusion matrix as ``(actual, predicted, n)`` with its zero cells.

    The classes are those seen in either column. The matrix is spread out from two exploded arrays of
    class names, then filled from the counts. That needs all names in one row, so more than ``MAX_CLASSES`` fail;
    without ``zero_cells`` any number goes, and only cells that occur are returned.
    """
    counts = (
        df.filter(F.col(y).isNotNull() & F.col(p).isNotNull())
        .groupBy(F.col(y).alias("actual"), F.col(p).alias("predicted"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if not zero_cells:
        return counts
    # The names of one class column at a time, and never more of them than the matrix may have.
    seen = counts.select("actual").union(counts.select("predicted")).distinct().limit(MAX_CLASSES + 1)
    names = F.collect_list("actual")
    too_many = F.raise_error(F.lit(f"more than {MAX_CLASSES} classes: use zero_cells=False"))
    classes = seen.agg(F.when(F.size(names) > MAX_CLASSES, too_many).otherwise(names).alias("_c"))
    cells = classes.select("_c", F.explode("_c").alias("actual")).select("actual", F.explode("_c").alias("predicted"))
    return cells.join(counts, ["actual", "predicted"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def confusion_binary(df: DataFrame, y: str, p: str) -> DataFrame:
    """One row with tn, fp, fn, tp."""
    return _counted(df, y, p).drop("_predicted")


def fbeta_from(tp: Column, fp: Column, fn: Column, beta: float) -> Column:
    b2 = float(beta) ** 2
    return _ratio(F.lit(1 + b2) * tp, F.lit(1 + b2) * tp + F.lit(b2) * fn + fp)


def binary_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts, precision, recall and F1 of class 1. 0 where undefined, null without any prediction."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    some = F.col("_predicted") > 0
    return _counted(df, y, p, by).select(
        *by,
        "tn",
        "fp",
        "fn",
        "tp",
        F.when(some, _ratio(tp, tp + fp)).alias("precision"),
        F.when(some, _ratio(tp, tp + fn)).alias("recall"),
        F.when(some, fbeta_from(tp, fp, fn, 1.0)).alias("f1"),
    )


def fbeta(df: DataFrame, y: str, p: str, betas: Sequence[float] = (1.0,), by: Sequence[str] = ()) -> DataFrame:
    """F-beta of class 1, one row per beta, from one pass over the data."""
    counted = _counted(df, y, p, by)
    scores = [
        F.struct(
            F.lit(float(b)).alias("beta"),
            F.when(F.col("_predicted") > 0, fbeta_from(F.col("tp"), F.col("fp"), F.col("fn"), b)).alias("fbeta"),
        )
        for b in betas
    ]
    return counted.select(*by, F.explode(F.array(*scores)).alias("_s")).select(*by, "_s.*")


def class_report(df: DataFrame, y: str, p: str, zero_division: float = 0.0) -> DataFrame:
    """Precision, recall, F1 and support of every class seen as label or prediction.

    Each (label, prediction) count is turned into its contributions to the two classes involved, so the
    report is two small aggregates after the one over the rows.
    """
    counts = (
        df.filter(F.col(y).isNotNull() & F.col(p).isNotNull())
        .groupBy(F.col(y).alias("_y"), F.col(p).alias("_p"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    zero, n, hit = F.lit(0), F.col("_n"), F.col("_y") == F.col("_p")
    as_actual = F.struct(F.col("_y").alias("class"), F.when(hit, n).otherwise(zero).alias("tp"), n.alias("actual"), zero.cast("long").alias("predicted"))
    as_predicted = F.struct(F.col("_p").alias("class"), zero.cast("long").alias("tp"), zero.cast("long").alias("actual"), n.alias("predicted"))
    per_class = (
        counts.select(F.explode(F.array(as_actual, as_predicted)).alias("_e"))
        .select("_e.*")
        .groupBy("class")
        .agg(F.sum("tp").alias("tp"), F.sum("actual").alias("support"), F.sum("predicted").alias("_predicted"))
    )
    tp, support, predicted = F.col("tp"), F.col("support"), F.col("_predicted")
    return per_class.select(
        "class",
        _ratio(tp, predicted, zero_division).alias("precision"),
        _ratio(tp, support, zero_division).alias("recall"),
        _ratio(F.lit(2) * tp, predicted + support, zero_division).alias("f1"),
        "support",
        "tp",
        predicted.alias("predicted"),
    )


def multiclass_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    """Macro F1, micro F1 and macro recall over the classes seen; null without any prediction."""
    report = class_report(df, y, p)
    return report.agg(
        F.avg("f1").alias("f1_macro"),
        F.try_divide(F.lit(2.0) * F.sum("tp"), F.sum("predicted") + F.sum("support")).alias("f1_micro"),
        F.avg("recall").alias("recall_macro"),
    )


def weighted_metrics(df: DataFrame, y: str, p: str, zero_division: float = 1.0) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1."""
    report = class_report(df, y, p, zero_division)
    total = F.sum("support")

    def weighted(col: str) -> Column:
        return F.try_divide(F.sum(F.col(col) * F.col("support")), total).alias(f"{col}_weighted")

    return report.agg(
        F.try_divide(F.sum("tp").cast("double"), total).alias("accuracy"),
        weighted("precision"),
        weighted("recall"),
        weighted("f1"),
    )


def error_rates(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """False-positive and false-negative rates; null when the class is empty."""
    counted = _counted(df, y, p, by)
    return counted.select(
        *by,
        _ratio(F.col("fp"), F.col("tn") + F.col("fp"), None).alias("false_positive_rate"),
        _ratio(F.col("fn"), F.col("fn") + F.col("tp"), None).alias("false_negative_rate"),
    )


def accuracy_ci(df: DataFrame, y: str, p: str, confidence: float = 0.95) -> DataFrame:
    """Accuracy with its normal-approximation interval, clipped to [0, 1]."""
    z = NormalDist().inv_cdf((1 + confidence) / 2.0)
    right = (F.col(y) == F.col(p)).cast("double")
    acc, half = F.col("accuracy"), F.col("_half")
    return (
        df.filter(F.col(y).isNotNull() & F.col(p).isNotNull())
        .agg(F.avg(right).alias("accuracy"), F.count(F.lit(1)).alias("n"))
        .withColumn("_half", F.lit(z) * F.sqrt(acc * (F.lit(1.0) - acc) / F.col("n")))
        .select(
            "n",
            "accuracy",
            F.greatest(acc - half, F.lit(0.0)).alias("ci_low"),
            F.least(acc + half, F.lit(1.0)).alias("ci_high"),
        )
    )


def class_counts(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def split_counts(df: DataFrame, splits: Sequence[str] = ("train", "test", "val")) -> DataFrame:
    return df.agg(*[F.sum(F.coalesce(F.col(s), F.lit(0))).alias(s) for s in splits])


def scorer(name: str, **options) -> Callable[[DataFrame, str, str], float | None]:
    """A metric by name as a function of (rows, label column, prediction column).

    ``f1``, ``fbeta`` (with ``beta``), ``precision``, ``recall``, ``f1_macro``, ``f1_micro``,
    ``recall_macro`` and ``accuracy``. Only the one number reaches the driver.
    """

    def score(df: DataFrame, y: str, p: str) -> float | None:
        if name == "fbeta":
            return fbeta(df, y, p, [options["beta"]]).first()["fbeta"]
        if name in ("f1", "precision", "recall"):
            return binary_metrics(df, y, p).first()[name]
        if name in ("f1_macro", "f1_micro", "recall_macro"):
            return multiclass_metrics(df, y, p).first()[name]
        if name == "accuracy":
            return accuracy_ci(df, y, p).first()["accuracy"]
        raise ValueError(f"unknown metric: {name}")

    score.__name__ = name
    return score


def default_scorer(multiclass: bool) -> Callable[[DataFrame, str, str], float | None]:
    """F1 for two classes, macro recall for more."""
    return scorer("recall_macro" if multiclass else "f1")


def metrics_long(metrics: DataFrame, run_id: str | Column) -> DataFrame:
    """One-row-per-run metrics as ``(run_id, name, value)`` lines for the run log."""
    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    names = [c for c in metrics.columns]
    return (
        metrics.select(run.alias("run_id"), *[F.col(c).cast("double").alias(c) for c in names])
        .unpivot(["run_id"], names, "name", "value")
    )
