import random
from difflib import get_close_matches

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import quality as Q
from reviewloom.operators.sampling import assign_splits


@pytest.fixture()
def texts(spark):
    data = [(1, "a", "x"), (2, "a", "y"), (3, None, "x"), (4, None, "x"), (5, "b", "x"), (6, "", "y")]
    return spark.createDataFrame(data, "id int, text string, source string")


def test_find_duplicates_counts_nulls_as_equal(texts):
    got = {r["id"]: r["n_copies"] for r in Q.find_duplicates(texts, ["text"]).collect()}
    assert got == {1: 2, 2: 2, 3: 2, 4: 2}
    assert {r["id"] for r in Q.find_duplicates(texts, ["text", "source"]).collect()} == {3, 4}


def test_drop_duplicates_keeps_the_first(texts):
    assert {r["id"] for r in Q.drop_duplicates(texts, ["text"], "id").collect()} == {1, 3, 5, 6}
    assert Q.drop_duplicates(texts, ["text"], "id").columns == texts.columns


def test_duplicates_with_one_hot_text(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "copy").otherwise(F.col("id").cast("string")).alias("text"))
    assert Q.find_duplicates(df, ["text"]).filter("n_copies = 1000").count() == 1000
    assert Q.drop_duplicates(df, ["text"], "id").count() == 2001


def test_cross_dataset(texts):
    rows = Q.cross_dataset_duplicates(texts, "text", "source").collect()
    assert [(r["text"], r["n_rows"], r["sources"]) for r in rows] == [("a", 2, "x,y")]


def test_clean_dataset(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, None, 3), (3, "c", 4)], "cid int, text string, pos int")
    assert {(r["cid"], r["text"]) for r in Q.clean_dataset(df, "cid", "text", "pos").collect()} == {(1, "a"), (3, "c")}


def test_add_cleaned_is_guarded(texts):
    once = Q.add_cleaned(texts, "text")
    assert "text_cleaned" in once.columns and Q.add_cleaned(once, "text") is once


def test_split_and_null_checks(spark):
    df = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (0, None, 1), (0, 0, None)], "train int, test int, val int")
    assert Q.invalid_splits(df).first()[0] == 2


def test_drift_sample(spark):
    old = spark.range(100).select("id", F.array(F.col("id").cast("double")).alias("v"))
    new = old.withColumn("v", F.when(F.col("id") < 50, F.array(F.col("id") + 1.0)).otherwise(F.col("v")))
    all_rows = Q.embedding_drift(old, new, "id", "v")
    assert all_rows.filter("not is_close").count() == 50
    some = Q.embedding_drift(old, new, "id", "v", n=10)
    assert some.count() == 10


@pytest.mark.parametrize("cutoff", [0.3, 0.5, 0.8, 1.0])
def test_fuzzy_filter_equals_difflib(spark, cutoff):
    rng = random.Random(5)
    refs = ["This request has to be turned down", "no", "x" * 300]
    values = [None, "", "no", "nO"]
    for _ in range(150):
        base = list(rng.choice(refs))
        for _ in range(rng.randrange(0, 12)):
            base[rng.randrange(len(base))] = rng.choice("abc xyz'")
        values.append("".join(base)[: rng.randrange(1, 320)])
    df = spark.createDataFrame(list(enumerate(values)), "id int, text string")
    kept = {r["id"] for r in Q.filter_close_matches(df, "text", refs, cutoff).collect()}
    expected = {i for i, v in enumerate(values) if v is None or not get_close_matches(v, refs, n=1, cutoff=cutoff)}
    assert kept == expected
    assert Q.filter_close_matches(df, "text", [], cutoff) is df


def test_gate(spark):
    clean = assign_splits(spark.range(50).select("id", F.concat(F.lit("t"), "id").alias("text")), "id")
    other = assign_splits(spark.range(50, 90).select("id", F.concat(F.lit("t"), "id").alias("text")), "id")
    Q.quality_gate(Q.quality_report({"a": clean, "b": other}, "text"))
    overlap = assign_splits(spark.range(49, 60).select("id", F.concat(F.lit("t"), "id").alias("text")), "id")
    broken = overlap.withColumn("train", F.lit(1)).withColumn("test", F.lit(1))
    with pytest.raises(Q.QualityGateError) as error:
        Q.quality_gate(Q.quality_report({"a": clean, "b": broken}, "text"))
    assert error.value.failures == [("*", "cross_dataset_duplicates", 2), ("b", "invalid_splits", 11)]


def test_drop_duplicates_with_ties_and_null_order(spark):
    rows = [("a", 2, "x"), ("a", 1, "y"), ("a", 1, "z"), ("b", None, "p"), ("b", None, "q"), ("c", None, "r"), ("c", 5, "s"), ("d", None, "t"), ("e", 1, "u"), ("e", 1, "u")]
    df = spark.createDataFrame(rows, "k string, pos int, v string")
    out = sorted((r.k, r.pos, r.v) for r in Q.drop_duplicates(df, ["k"], "pos").collect())
    assert [r[0] for r in out] == list("abcde") and [r[1] for r in out] == [1, None, 5, None, 1]
    again = Q.drop_duplicates(df.repartition(5).sortWithinPartitions(F.desc("v")), ["k"], "pos")
    assert sorted((r.k, r.pos, r.v) for r in again.collect()) == out


def test_unique_rows_are_not_shuffled(spark):
    df = spark.range(100).select("id", F.concat(F.lit("text "), "id").alias("text"))
    plan = Q.drop_duplicates(df, ["text"], "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "strategy=broadcast" in plan


def test_report_takes_one_frame_with_a_dataset_column(spark):
    rows = [(1, "a", "x", 1), (2, "a", "x", 1), (3, "a", "y", 0), (4, "b", None, 2), (5, "b", None, 1), (6, None, "y", 1)]
    df = spark.createDataFrame(rows, "id int, text string, part string, train int").withColumns({"test": F.lit(0), "val": F.lit(0)})
    got = {(r.dataset, r.check_name): r.n_bad for r in Q.quality_report(df, "text", dataset_col="part").collect()}
    assert got == {
        ("x", "duplicate_texts"): 2, ("y", "duplicate_texts"): 0, (None, "duplicate_texts"): 2,
        ("x", "invalid_splits"): 0, ("y", "invalid_splits"): 1, (None, "invalid_splits"): 1, ("*", "cross_dataset_duplicates"): 5,
    }
    none = Q.quality_report(df.filter("id > 9"), "text", dataset_col="part").collect()
    assert [tuple(r) for r in none] == [("*", "cross_dataset_duplicates", 0)]
