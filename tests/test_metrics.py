import math

import pytest

from reviewloom.operators import metrics as M


def frame(spark, pairs):
    return spark.createDataFrame([(i, y, p) for i, (y, p) in enumerate(pairs)], "id bigint, y int, p int")


HAND = [(1, 1)] * 3 + [(0, 1)] * 1 + [(1, 0)] * 2 + [(0, 0)] * 4


def test_binary(spark):
    r = M.binary_metrics(frame(spark, HAND), "y", "p").first()
    assert (r["tn"], r["fp"], r["fn"], r["tp"]) == (4, 1, 2, 3)
    assert r["precision"] == 0.75 and r["recall"] == 0.6
    assert r["f1"] == pytest.approx(2 * 0.75 * 0.6 / 1.35)
    scores = {r["beta"]: r["fbeta"] for r in M.fbeta(frame(spark, HAND), "y", "p", [0.75, 2]).collect()}
    assert scores[2.0] == pytest.approx(5 * 0.75 * 0.6 / (4 * 0.75 + 0.6))
    assert scores[0.75] == pytest.approx(1.5625 * 0.75 * 0.6 / (0.5625 * 0.75 + 0.6))


@pytest.mark.parametrize("pairs", [[], [(1, None), (0, None)]])
def test_no_predictions_give_null(spark, pairs):
    r = M.binary_metrics(frame(spark, pairs), "y", "p").first()
    assert r["f1"] is None and r["precision"] is None
    m = M.multiclass_metrics(frame(spark, pairs), "y", "p").first()
    assert m["f1_macro"] is None and m["recall_macro"] is None
    assert M.confusion(frame(spark, pairs), "y", "p").count() == 0


def test_one_class_only(spark):
    r = M.binary_metrics(frame(spark, [(0, 0)] * 3), "y", "p").first()
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0)
    e = M.error_rates(frame(spark, [(0, 0)] * 3), "y", "p").first()
    assert e["false_positive_rate"] == 0.0 and e["false_negative_rate"] is None


THREE = [(0, 0), (0, 0), (0, 1), (1, 1), (1, 2), (2, 0), (2, None), (3, 3)]


def test_confusion_has_zero_cells(spark):
    cells = {(r["actual"], r["predicted"]): r["n"] for r in M.confusion(frame(spark, THREE), "y", "p").collect()}
    assert len(cells) == 16 and cells[(0, 0)] == 2 and cells[(3, 0)] == 0 and sum(cells.values()) == 7


def test_multiclass_by_hand(spark):
    report = {r["class"]: r for r in M.class_report(frame(spark, THREE), "y", "p").collect()}
    assert report[0]["precision"] == pytest.approx(2 / 3) and report[0]["recall"] == pytest.approx(2 / 3)
    assert report[1]["precision"] == 0.5 and report[1]["recall"] == 0.5
    assert report[2]["precision"] == 0.0 and report[2]["f1"] == 0.0 and report[2]["support"] == 1
    m = M.multiclass_metrics(frame(spark, THREE), "y", "p").first()
    assert m["f1_macro"] == pytest.approx((2 / 3 + 0.5 + 0 + 1) / 4)
    assert m["f1_micro"] == pytest.approx(4 / 7)
    assert m["recall_macro"] == pytest.approx((2 / 3 + 0.5 + 0 + 1) / 4)


def test_weighted_with_undefined_as_one(spark):
    pairs = [(0, 0), (0, 0), (1, 0), (0, 2)]
    w = M.weighted_metrics(frame(spark, pairs), "y", "p").first()
    # class 1 is never predicted: precision counts as 1; class 2 has no support and no weight
    assert w["accuracy"] == 0.5
    assert w["precision_weighted"] == pytest.approx((2 / 3 * 3 + 1.0 * 1) / 4)
    assert w["recall_weighted"] == pytest.approx(0.5)


def test_accuracy_interval(spark):
    r = M.accuracy_ci(frame(spark, HAND), "y", "p").first()
    half = 1.959963984540054 * math.sqrt(0.7 * 0.3 / 10)
    assert r["accuracy"] == pytest.approx(0.7) and r["ci_low"] == pytest.approx(0.7 - half)
    assert r["ci_high"] == pytest.approx(0.7 + half)
    sure = M.accuracy_ci(frame(spark, [(1, 1)] * 4), "y", "p").first()
    assert (sure["ci_low"], sure["ci_high"]) == (1.0, 1.0)


def test_scorers(spark):
    df = frame(spark, HAND)
    assert M.scorer("f1")(df, "y", "p") == pytest.approx(2 / 3)
    assert M.scorer("fbeta", beta=2)(df, "y", "p") == pytest.approx(5 * 3 / (5 * 3 + 4 * 2 + 1))
    assert M.default_scorer(False).__name__ == "f1" and M.default_scorer(True).__name__ == "recall_macro"
    assert M.default_scorer(True)(df, "y", "p") == pytest.approx((0.8 + 0.6) / 2)
    assert M.scorer("accuracy")(df, "y", "p") == pytest.approx(0.7)
    with pytest.raises(ValueError):
        M.scorer("auc")(df, "y", "p")


def test_confusion_of_many_classes(spark, monkeypatch):
    rows = spark.createDataFrame([(i, i) for i in range(30)] + [(0, 1)], "y int, p int")
    assert M.confusion(rows, "y", "p").count() == 900
    monkeypatch.setattr(M, "MAX_CLASSES", 29)
    with pytest.raises(Exception, match="more than 29 classes"):
        M.confusion(rows, "y", "p").collect()
    cells = M.confusion(rows, "y", "p", zero_cells=False).collect()
    assert sorted((r["actual"], r["predicted"], r["n"]) for r in cells) == sorted([(i, i, 1) for i in range(30)] + [(0, 1, 1)])
