import math
import random
from itertools import combinations
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import exact_tests


def test_normal_quantile(spark):
    ps = [1e-9, 1e-4, 0.01, 0.02425, 0.3, 0.5, 0.77, 0.98, 1 - 1e-6]
    out = spark.createDataFrame([(p,) for p in ps], "p double").select("p", exact_tests.normal_quantile(F.col("p")).alias("z")).collect()
    for r in out:
        assert r.z == pytest.approx(NormalDist().inv_cdf(r.p), rel=2e-9, abs=1e-9)


def brute_w(values):
    """Squared correlation with the scores of mid-ranks, from sorted values."""
    xs, n = sorted(values), len(values)
    mids = [sum(i for i, y in enumerate(xs, 1) if y == x) / xs.count(x) for x in xs]
    ms = [NormalDist().inv_cdf((r - 0.375) / (n + 0.25)) for r in mids]
    mx, mm = sum(xs) / n, sum(ms) / n
    top = sum((x - mx) * (m - mm) for x, m in zip(xs, ms, strict=True))
    return top**2 / sum((x - mx) ** 2 for x in xs) / sum((m - mm) ** 2 for m in ms)


def test_shapiro_francia_equals_sorted_values(spark):
    rnd = random.Random(2)
    groups = {
        "normal": [rnd.gauss(1e6, 2) for _ in range(200)], "ties": [float(rnd.randint(0, 6)) for _ in range(150)],
        "skewed": [math.exp(rnd.gauss(0, 1)) for _ in range(200)], "few": [1.0, 2.0], "same": [3.0] * 9, "three": [1.0, 5.0, 6.0],
    }
    rows = [(g, x) for g, xs in groups.items() for x in xs] + [("normal", None), ("normal", float("nan")), ("normal", float("inf")), (None, 1.0)]
    out = {r.g: r for r in exact_tests.shapiro_francia(spark.createDataFrame(rows, "g string, x double"), ["g"], "x").collect()}
    assert set(out) == set(groups)
    for g in ("normal", "ties", "skewed", "three"):
        assert out[g].n == len(groups[g]) and out[g].w == pytest.approx(brute_w(groups[g]), rel=1e-7)
    assert out["few"].w is None and out["same"].w is None and out["three"].z is None
    assert out["normal"].is_normal and not out["skewed"].is_normal and out["skewed"].p_value < 1e-6


def test_ways_equal_all_choices(spark):
    sizes = [(1, 1), (1, 7), (3, 4), (5, 5), (2, 9)]
    df = spark.createDataFrame(sizes, "a long, b long").select("a", "b", exact_tests.rank_sum_ways(F.col("a"), F.col("a") + F.col("b")).alias("ways"))
    for r in df.collect():
        us = [sum(c) - r.a * (r.a + 1) // 2 for c in combinations(range(1, r.a + r.b + 1), r.a)]
        assert r.ways == [us.count(u) for u in range(r.a * r.b + 1)]


def test_exact_p_of_known_samples(spark):
    rows = [("apart", 1, x) for x in (1.0, 2.0, 3.0)] + [("apart", 0, x) for x in (4.0, 5.0, 6.0, 7.0)]
    rows += [("tied", 1, x) for x in (1.0, 2.0)] + [("tied", 0, x) for x in (2.0, 3.0)] + [("one side", 1, 1.0), ("one side", None, 2.0)]
    out = {r.k: r for r in exact_tests.mann_whitney_by(spark.createDataFrame(rows, "k string, g int, x double"), ["k"], "g", "x").collect()}
    assert set(out) == {"apart", "tied"}
    assert out["apart"].exact and out["apart"].u == 0 and out["apart"].p_value == pytest.approx(2 / 35)
    assert not out["tied"].exact
