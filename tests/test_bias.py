import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import bias, distribution
from reviewloom.plans import value_ranks as V


def groups(spark, one, two):
    data = [(1, float(x)) for x in one] + [(0, float(x)) for x in two]
    return spark.createDataFrame(data, "g int, x double")


def u_by_hand(one, two):
    return sum((a > b) + 0.5 * (a == b) for a in one for b in two)


@pytest.fixture(scope="module")
def samples():
    rng = random.Random(3)
    return [rng.randrange(12) for _ in range(60)], [rng.randrange(3, 15) for _ in range(90)]


def test_mann_whitney(spark, samples):
    one, two = samples
    r = bias.mann_whitney(groups(spark, one, two), "g", "x").first()
    assert (r["n1"], r["n2"]) == (60, 90) and r["u"] == u_by_hand(one, two)
    n, pooled = 150, one + two
    ties = sum(c**3 - c for c in (pooled.count(v) for v in set(pooled)))
    sd = math.sqrt(60 * 90 / 12 * ((n + 1) - ties / (n * (n - 1))))
    z = (max(r["u"], 5400 - r["u"]) - 2700 - 0.5) / sd
    assert r["p_value"] == pytest.approx(math.erfc(z / math.sqrt(2))) and r["significant"] == (r["p_value"] < 0.05)


def test_cohens_d(spark, samples):
    one, two = samples
    r = bias.cohens_d(groups(spark, one, two), "g", "x").first()
    pooled = ((59 * statistics.variance(one)) + 89 * statistics.variance(two)) / 148
    assert r["cohens_d"] == pytest.approx((statistics.mean(one) - statistics.mean(two)) / math.sqrt(pooled))


def test_zero_variance_and_empty_side(spark):
    assert bias.cohens_d(groups(spark, [1, 1], [1, 1]), "g", "x").first()["cohens_d"] is None
    r = bias.mann_whitney(groups(spark, [1, 2], []), "g", "x").first()
    assert (r["n1"], r["n2"]) == (2, 0) and r["p_value"] is None


@pytest.mark.parametrize(
    "t,dof,p",
    [(2.0, 10, 0.0733880), (0.0, 5, 1.0), (12.706, 1, 0.0500008), (1.96, 1e6, 0.0499965), (-3.5, 20, 0.0022568)],
)
def test_student_t(t, dof, p):
    assert bias.student_t_p(t, dof) == pytest.approx(p, abs=2e-5)


def test_t_test_needs_normal_groups(spark):
    bell = [statistics.NormalDist(0, 1).inv_cdf((i + 0.5) / 80) for i in range(80)]
    r = bias.t_test(groups(spark, bell, [x + 0.5 for x in bell]), "g", "x").first()
    assert r["both_normal"] and 0 < r["p_value"] < 0.01
    skewed = [math.exp(3 * x) for x in bell]
    r = bias.t_test(groups(spark, bell, skewed), "g", "x").first()
    assert not r["both_normal"] and r["p_value"] is None and r["t"] is not None


def test_tiny_groups_are_not_normal(spark):
    rows = {r["g"]: r["is_normal"] for r in bias.normality(groups(spark, [1, 2], [1, 2, 3, 4]), "g", "x").collect()}
    assert rows == {1: False, 0: True}


def test_audit_against_single_tests(spark):
    rng = random.Random(8)
    data = [(rng.randrange(2), rng.randrange(2), rng.randrange(40), rng.random()) for _ in range(400)]
    data += [(0, None, 3, 0.5), (1, 2, 9, None)]
    df = spark.createDataFrame(data, "y int, p int, a int, b double")
    out = {(r["feature"], r["comparison"]): r for r in bias.bias_audit(df, ["a", "b"], "y", "p").collect()}
    assert len(out) == 6
    tp = [r[2] for r in data if r[:2] == (1, 1)]
    fn = [r[2] for r in data if r[:2] == (1, 0)]
    r = out[("a", "tp_vs_fn")]
    assert (r["n1"], r["n2"], r["u"]) == (len(tp), len(fn), u_by_hand(tp, fn))
    right = [r[3] for r in data if r[0] == r[1]]
    wrong = [r[3] for r in data if r[0] != r[1] and r[3] is not None]
    r = out[("b", "correct_vs_incorrect")]
    assert (r["n1"], r["n2"]) == (len(right), len(wrong)) and r["u"] == u_by_hand(right, wrong)


@pytest.mark.parametrize("ranges", [2, 16, 256])
def test_value_ranks(spark, monkeypatch, ranges):
    monkeypatch.setattr(V, "range_count", lambda df: ranges)
    rng = random.Random(1)
    data = [("hot", 7.0)] * 700 + [(rng.choice(["a", "hot"]), round(rng.gauss(0, 3), 1)) for _ in range(1500)] + [("a", None)]
    df = spark.createDataFrame(data, "g string, x double").repartition(5)
    for few in (True, False):
        rows = V.value_ranks(df, ["g"], "x", {"twice": F.sum(F.lit(2))}, few_keys=few).collect()
        for r in rows:
            values = [x for g, x in data if g == r["g"] and x is not None]
            assert r["n"] == values.count(r["x"]) and r["below"] == sum(x < r["x"] for x in values)
            assert r["total"] == len(values) and r["twice"] == 2 * r["n"]


def test_box_stats_and_histogram(spark):
    values = [1, 2, 2, 3, 4, 5, 6, 7, 100]
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("b", 5.0)], "g string, x double")
    r = {r["g"]: r for r in distribution.box_stats(df, "g", "x").collect()}
    q = statistics.quantiles(values, n=4, method="inclusive")
    assert [r["a"][c] for c in ("q1", "median", "q3")] == q
    assert (r["a"]["whisker_low"], r["a"]["whisker_high"]) == (1.0, 7.0)
    assert (r["b"]["n"], r["b"]["q1"], r["b"]["whisker_high"]) == (1, 5.0, 5.0)
    bins = {(x["g"], x["bin"]): x["n"] for x in distribution.histogram(df, "g", "x", 10).collect()}
    assert bins == {("a", 0): 8, ("a", 9): 1, ("b", 0): 1}


def test_text_features(spark):
    df = spark.createDataFrame([(1, "Good good bda"), (2, ""), (3, "the end"), (4, None)], "id int, text string")
    known = spark.createDataFrame([("good",), ("the",), ("end",)], "token string")
    lexicon = spark.createDataFrame([("good", 0.5), ("bda", -1.0)], "token string, polarity double")
    r = {r["id"]: r for r in bias.text_features(df, "id", "text", known, lexicon).collect()}
    assert (r[1]["text_length"], r[1]["sentiment"], r[1]["spelling_mistakes"]) == (3, 0.0, 1)
    assert r[1]["spelling_mistakes_rate"] == pytest.approx(1 / 3)
    assert (r[2]["text_length"], r[2]["sentiment"], r[2]["spelling_mistakes_rate"]) == (0, 0.0, 0.0)
    assert (r[3]["spelling_mistakes"], r[3]["spelling_mistakes_rate"]) == (0, 0.0)
