"""Arrays as vectors: concatenation, softmax, top class and tolerance checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat_vectors(*vectors: Column | str) -> Column:
    """Vectors end to end, e.g. title ++ body."""
    return F.concat(*vectors)


def softmax(logits: Column | str) -> Column:
    c = F.col(logits) if isinstance(logits, str) else logits
    top = F.array_max(c)
    powers = F.transform(c, lambda x: F.exp((x - top).cast("double")))
    total = F.aggregate(powers, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(powers, lambda x: x / total)


def argmax(scores: Column | str) -> Column:
    """Index of the first maximum, from 0."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def top_class(scores: Column | str, from_logits: bool = True) -> Column:
    """``struct(class, probability)`` of the best score, worked out per row."""
    c = F.col(scores) if isinstance(scores, str) else scores
    if from_logits:
        top = F.array_max(c)
        total = F.aggregate(c, F.lit(0.0), lambda acc, x: acc + F.exp((x - top).cast("double")))
        probability = F.lit(1.0) / total
    else:
        probability = F.array_max(c).cast("double")
    return F.struct(argmax(c).alias("class"), probability.alias("probability"))


def all_close(stored: Column | str, fresh: Column | str, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """True when the vectors have one length and agree within a tolerance scaled by ``fresh``."""
    near = F.forall(
        F.zip_with(
            stored,
            fresh,
            lambda a, b: F.abs(a.cast("double") - b.cast("double"))
            <= F.lit(atol) + F.lit(rtol) * F.abs(b.cast("double")),
        ),
        lambda ok: F.coalesce(ok, F.lit(False)),
    )
    return F.coalesce((F.size(stored) == F.size(fresh)) & near, F.lit(False))
