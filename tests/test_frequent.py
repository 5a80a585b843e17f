"""Frequent terms by sketch and recount, against counting everything."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import terms


def _counted(lists, k):
    counts = Counter(t for ts in lists for t in ts or [] if t is not None)
    return sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:k]


@pytest.mark.parametrize("tracked, most", [(64, 1 << 19), (64, 64), (16, 512)])
def test_equal_to_counting_all(spark, monkeypatch, tracked, most):
    """Whether a small sketch is enough, grows, or is given up."""
    monkeypatch.setattr(terms, "MOST_TRACKED", most)
    draw = random.Random(3)
    skewed = [[f"w{int(draw.paretovariate(0.8)) % 5000}" for _ in range(40)] for _ in range(300)]
    flat = [[f"f{draw.randrange(3000)}" for _ in range(20)] for _ in range(200)]
    odd = [[], None, [None, "w1", None], ["hot"] * 3000, ["", "", " "], ["tie a"] * 7, ["tie b"] * 7]
    for lists in (skewed + odd, flat + odd, [["a", "b"], ["a"]], [None], []):
        df = spark.createDataFrame([(ts,) for ts in lists], "words array<string>").repartition(5)
        for k in (1, 40):
            got = [tuple(r) for r in terms.frequent_terms(df, F.col("words"), k, tracked=tracked).collect()]
            assert got == _counted(lists, k), (len(lists), k)


def test_sketches_merged_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(terms, "FAN_IN", 2)
    lists = [[f"w{i % 7}", f"w{i % 3}", "w0"] for i in range(500)]
    df = spark.createDataFrame([(ts,) for ts in lists], "words array<string>").repartition(9)
    got = [tuple(r) for r in terms.frequent_terms(df, F.col("words"), 4, tracked=16).collect()]
    assert got == _counted(lists, 4)


def test_one_small_sketch_is_enough_for_a_large_head(spark, monkeypatch):
    steps = []
    sketched = terms._sketched
    monkeypatch.setattr(terms, "_sketched", lambda *a: steps.append(a[2]) or sketched(*a))
    rows = spark.range(60_000).select(F.array(F.lit("the"), F.concat(F.lit("r"), "id")).alias("words"))
    assert [tuple(r) for r in terms.frequent_terms(rows, F.col("words"), 1, tracked=1024).collect()] == [("the", 60_000)]
    assert steps == [1024]
    with pytest.raises(ValueError):
        terms.frequent_terms(rows, F.col("words"), 0)
