import math

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from reviewloom.operators import moderate as R
from reviewloom.operators import train
from reviewloom.operators.sampling import assign_splits
from reviewloom.plans.session import shared_dir
from reviewloom.streaming import moderation as S


@pytest.fixture(scope="module")
def points(spark):
    """Two well separated clusters with some noise in the label."""
    x = F.when(F.col("y") == 1, 2.0).otherwise(-2.0) + (F.col("id") % 7) / 7.0
    noise = F.when(F.col("id") % 29 == 0, 1 - F.col("y")).otherwise(F.col("y"))
    df = spark.range(400).withColumn("y", (F.col("id") % 2).cast("int"))
    df = df.withColumn("v", F.array(x, (F.col("id") % 5).cast("double"))).withColumn("y", noise.cast("int"))
    return assign_splits(df, "id")


@pytest.mark.parametrize("kind", ["SVM", "logistic_regression", "random_forest", "xgboost"])
def test_train_score_save_load(points, spark, kind):
    params = {"C": 10, "n_estimators": 5, "max_depth": 3, "max_iter": 8}
    model = train.train(train.with_features(points.filter("train = 1"), "v", "y"), kind, params)
    scored = train.score(points, model, "v")
    assert scored.filter("prediction = y").count() > 370
    assert scored.columns[: len(points.columns)] == points.columns and "decision" in scored.columns
    path = shared_dir(spark, "model")
    train.save_model(model, path)
    again = train.score(points, train.load_model(path), "v")
    assert [r["prediction"] for r in again.orderBy("id").collect()] == [r["prediction"] for r in scored.orderBy("id").collect()]
    with pytest.raises(ValueError):
        train.estimator("tree", {}, 1)


@pytest.mark.parametrize("kind,classes", [("logistic_regression", 2), ("random_forest", 2), ("SVM", 3)])
def test_scoring_works_in_an_observed_session(spark, kind, classes):
    other = spark.newSession()
    df = other.range(60).withColumn("y", (F.col("id") % classes).cast("int"))
    df = df.withColumn("v", F.array(F.col("y") * 4.0, F.col("y") * F.col("y") * 1.0))
    model = train.train(train.with_features(df, "v", "y"), kind, {"n_estimators": 3, "max_iter": 5}, n_classes=classes)
    seen = Observation("rows")
    df.observe(seen, F.count(F.lit(1)).alias("n")).count()
    assert seen.get == {"n": 60}
    assert train.score(df, model, "v").filter("prediction is not null").count() == 60


@pytest.mark.parametrize("kind", ["SVM", "random_forest"])
def test_three_classes(spark, kind):
    df = spark.range(150).withColumn("y", (F.col("id") % 3).cast("int"))
    df = df.withColumn("v", F.array((F.col("y") == 1).cast("double") * 4, (F.col("y") == 2).cast("double") * 4, F.rand(1)))
    model = train.train(train.with_features(df, "v", "y"), kind, {"C": 10, "n_estimators": 5, "max_iter": 5}, n_classes=3)
    assert train.score(df, model, "v").filter("prediction = y").count() > 140


def test_bag_of_words(spark):
    df = spark.createDataFrame([("Bad bad day", 1), ("good day", 0), ("so bad", 1), ("good good", 0)] * 20, "text string, y int")
    words = train.bow(df, "text", 3)
    assert words.stages[1].vocabulary == ["bad", "good", "day"]
    model = train.train_text(df, "text", "y", params={"C": 1.0, "max_iter": 20})
    assert R.nae_rule(df, model, "p").filter("p = y").count() == df.count()


def test_grid(points):
    result = train.grid_cv(train.with_features(points, "v", "y"), "id", strengths=(0.001, 10), folds=3, max_iter=20)
    assert len(result.table) == 4 and result.best_params["penalty"] in ("l1", "l2")
    assert max(r[2] for r in result.table) > 0.9


def test_search_mix_takes_what_it_says(points):
    datasets = {
        "pos": points.filter("y = 1"),
        "neg": points.filter("y = 0 and id < 200"),
        "more": points.filter("y = 0 and id >= 200"),
    }
    result = train.search_mix(datasets, ["pos"], "logistic_regression", "y", "id", "v", trials=3, fixed={"max_iter": 10})
    sizes = {k: d.filter("train = 1").count() for k, d in datasets.items()}
    for trial in result.trials:
        assert set(trial["rows"]) == {"neg", "more"}
        assert all(1 <= n <= sizes[s] for s, n in trial["rows"].items())
    assert result.best_score == max(t["score"] for t in result.trials) > 0.8
    again = train.search_mix(datasets, ["pos"], "logistic_regression", "y", "id", "v", trials=3, fixed={"max_iter": 10}, parallelism=1)
    assert [t["rows"] for t in again.trials] == [t["rows"] for t in result.trials] and again.best_score == result.best_score


RULES = [
    R.keyword_rule("complaint", ["sue", "legal action"]),
    R.severity_rule("safeguarding", ["overdose"], ["hurt"]),
    R.lacks_rule("not_an_experience", ["i", "my", "we"]),
    R.mentions_rule("names", ["smith"]),
    R.pairs_rule("descriptions", ["tall"]),
]
REVIEWS = [
    (1, "I will take LEGAL  action"),
    (2, "my issue is fine"),
    (3, "we heard of hurt and\noverdose"),
    (4, "Great place, Dr Smith and the tall man; tall"),
    (5, None),
]


def test_rules(spark):
    df = spark.createDataFrame(REVIEWS, "id int, text string")
    rows = {r["id"]: r for r in R.moderate(df, "text", RULES).collect()}
    assert [rows[1][r.name] for r in RULES] == [1, 0, 0, 0, 0] and rows[1]["flagged"]
    assert not rows[2]["flagged"]
    assert rows[3]["safeguarding"] == 1  # the newline vanishes, so "and" and "overdose" are one word
    assert [rows[4][r.name] for r in RULES] == [0, 0, 1, 1, 1]
    assert rows[5]["flagged"] is False or rows[5]["flagged"] is None


def test_model_as_rule(points, spark):
    model = train.train(train.with_features(points, "v", "y"), "logistic_regression", {"C": 10})

    def rule(df):
        return R.uninformative_rule(df, "v", model)

    rule.flag_col = "uninformative"
    out = R.moderate(points.withColumn("text", F.lit("we sue")), "text", [RULES[0], rule])
    assert out.filter("complaint = 1 and flagged").count() == 400 and "uninformative_probability" in out.columns


def test_stream_equals_batch(spark):
    home = shared_dir(spark, "stream")
    df = spark.createDataFrame([(i, t) for i in range(8) for _x, t in REVIEWS], "id int, text string")
    df.repartition(4).write.parquet(f"{home}/in")
    stream = S.read_stream(spark, f"{home}/in", df.schema, max_files_per_trigger=1)
    S.moderate_stream(stream, "text", RULES, f"{home}/out", f"{home}/cp", available_now=True).awaitTermination()
    got = sorted(map(str, spark.read.parquet(f"{home}/out").collect()))
    assert got == sorted(map(str, R.moderate(df, "text", RULES).collect()))
    df.limit(3).write.mode("append").parquet(f"{home}/in")
    S.moderate_stream(S.read_stream(spark, f"{home}/in", df.schema), "text", RULES, f"{home}/out", f"{home}/cp", available_now=True).awaitTermination()
    assert spark.read.parquet(f"{home}/out").count() == df.count() + 3


def test_requests(spark):
    df = spark.createDataFrame([('{"data": ["a", "b"]}',), ('{"data": "c"}',), ('{"data": "[d]"}',)], "value string")
    assert sorted(r["text"] for r in S.requests_to_texts(df).collect()) == ["[d]", "a", "b", "c"]


def test_fourier_features_approach_the_kernel(spark):
    """Inner products of features against exp(-gamma * squared distance)."""
    from reviewloom.operators.kernel import FourierFeatures

    points = [[0.0, 0.0, 1.0], [0.5, -0.2, 0.8], [2.0, 1.0, -1.0], [0.1, 0.1, 1.1]]
    df = train.with_features(spark.createDataFrame([(p,) for p in points], "v array<double>"), "v")
    made = FourierFeatures(inputCol=train.FEATURES, outputCol="w", gamma=0.7, size=20_000, dims=3).transform(df)
    w = [r["w"].toArray() for r in made.collect()]
    for i, p in enumerate(points):
        for j, q in enumerate(points):
            want = math.exp(-0.7 * sum((a - b) ** 2 for a, b in zip(p, q)))
            assert abs(w[i] @ w[j] - want) < 0.03
    with pytest.raises(ValueError):
        FourierFeatures(inputCol=train.FEATURES, outputCol="w", gamma=0.0, size=2, dims=3).transform(df)


def test_fourier_features_of_a_large_batch_in_little_memory():
    """What one batch needs beyond itself does not grow with its rows."""
    import tracemalloc

    import numpy as np
    import pandas as pd

    from reviewloom.operators import kernel

    points = np.random.default_rng(1).normal(size=(20_001, 3))
    directions, phases = kernel._waves(0.7, 512, 3, 42)
    done = 0
    tracemalloc.start()
    for part in kernel._in_chunks(iter([pd.Series([], dtype=object), pd.Series(list(points))]), 0.7, 512, 3, 42):
        want = np.cos(points[done : done + len(part)] @ directions + phases) * np.sqrt(2.0 / 512)
        assert np.allclose(np.stack(part.to_numpy()), want, rtol=0, atol=1e-12)
        done += len(part)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert done == 20_001 and peak < 30e6  # all features at once are 82 MB


def test_kernel_with_three_classes_and_missing_vectors(spark):
    """Rings around the origin: a kernel machine parts them, and rows without a vector get no prediction."""
    rows = [(i, [(1 + 2 * (i % 3)) * math.cos(i), (1 + 2 * (i % 3)) * math.sin(i)], i % 3) for i in range(300)] + [(999, None, 1)]
    df = spark.createDataFrame(rows, "id long, v array<double>, y int")
    model = train.train(train.with_features(df, "v", "y"), "SVM", {"C": 100, "gamma": 0.5, "n_features": 300}, n_classes=3)
    out = {r.id: r for r in train.score(df, model, "v").collect()}
    assert out[999].prediction is None
    assert sum(out[i].prediction == i % 3 for i in range(300)) >= 285


def test_parameters_that_spark_cannot_fit_are_refused():
    for kind, params in (("random_forest", {"max_depth": 31}), ("random_forest", {"min_samples_leaf": 0.5}), ("xgboost", {"max_depth": 100})):
        with pytest.raises(ValueError, match="must be between"):
            train.estimator(kind, params, 10)
