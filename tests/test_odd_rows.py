"""Null texts and vectors, missing counterparts, unusual names and values."""

from pyspark.sql import functions as F

from reviewloom.operators import distribution, external, quality, submissions, train


def test_null_inputs_are_scored_null(spark):
    rows = [(i, f"good fine {i}" if i % 2 else "bad awful", [float(i % 2), 1.0], i % 2) for i in range(40)]
    df = spark.createDataFrame([*rows, (40, None, None, 1), (41, "x", [0.5, 1.0], None)], "id int, text string, v array<float>, y int")
    for model, col in ((train.train_text(df, "text", "y"), None), (train.train(train.with_features(df, "v", "y"), "logistic_regression"), "v")):
        out = {r.id: r for r in train.score(df, model, col).collect()}
        assert out[40].prediction is None and out[40].probability is None and out[40].text is None and out[40].v is None
        assert all(out[i].prediction == i % 2 for i in range(40)) and out[41].prediction is not None


def test_external_models_are_called_once(spark):
    class Client:
        def score(self, texts):
            return [("short", 0.5) for _ in texts]

    df = spark.createDataFrame([("a",)], "text string")
    plan = external.score_external(df, Client, "text").filter("label = 'short'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_missing_fresh_vector_is_drift(spark):
    old = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "id int, v array<double>")
    out = quality.embedding_drift(old, old.filter("id = 1"), "id", "v")
    assert sorted((r.id, r.is_close) for r in out.collect()) == [(1, True), (2, False)]


def test_inferred_names_are_kept(spark):
    df = spark.createDataFrame([('{"AVOID": "x", "OBJECTS": {"VOIDED": null}}',)], "j string")
    row = submissions.unpack_json(df, "j").first()
    assert row.AVOID == "x" and row.OBJECTS.VOIDED is None


def test_histogram_leaves_out_nan(spark):
    df = spark.createDataFrame([("a", float(x)) for x in range(10)] + [("a", float("nan")), ("a", float("inf"))], "g string, x double")
    out = distribution.histogram(df, "g", "x", 5)
    assert sorted((r.bin, r.n) for r in out.collect()) == [(b, 2) for b in range(5)]
    assert out.agg(F.sum("n")).first()[0] == 10
