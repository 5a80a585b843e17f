import hashlib

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import augment as A

TEXTS = [(1, "One. Two. Three. "), (2, "only one"), (3, ""), (4, None), (5, "the cat. The  dog of\nthe house. of")]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(TEXTS, "id int, text string")


def h(*parts):
    return hashlib.md5("|".join(["42", *map(str, parts)]).encode()).hexdigest()


def shuffled(row_id, text, copy):
    pieces = [s for s in text.split(".") if s.strip()]
    if len(pieces) < 2:
        return text
    return ". ".join(s for _h, s in sorted((h(row_id, copy, i), s.strip()) for i, s in enumerate(pieces)))


def test_shuffle_matches_python(df):
    got = {(r["id"], r["copy"]): r["text"] for r in A.shuffle_sentences(df, "id", "text", 3).collect()}
    assert got == {(i, c): shuffled(i, t, c) for i, t in TEXTS if t is not None for c in (1, 2, 3)}


def test_shuffle_ignores_partitioning(df):
    a = A.shuffle_sentences(df.repartition(7), "id", "text", 2).collect()
    assert sorted(map(str, a)) == sorted(map(str, A.shuffle_sentences(df.coalesce(1), "id", "text", 2).collect()))


def substituted(row_id, text, copy, table, rate, stop):
    out = []
    for i, s in enumerate([s for s in text.split(".") if s.strip()]):
        words = s.strip().split(" ")
        for j, w in enumerate(words):
            draw = int(h(row_id, copy, i, j)[:8], 16) / 2**32
            if draw < rate and w.lower() not in stop and w.lower() in table:
                words[j] = table[w.lower()]
        out.append(" ".join(words))
    return ". ".join(out)


@pytest.mark.parametrize("rate", [0.0, 0.5, 1.0])
def test_substitution_by_literal_and_by_join(spark, df, rate):
    table = {"the": "this", "of": "from", "cat": "tiger", "one": "1"}
    synonyms = spark.createDataFrame(list(table.items()), "token string, synonym string")
    expected = {(i, c): substituted(i, t, c, table, rate, {"of"}) for i, t in TEXTS if t is not None for c in (1, 2)}
    for limit in (1000, 2):
        out = A.substitute_words(df, "id", "text", synonyms, 2, rate, ["of"], max_literal=limit)
        assert {(r["id"], r["copy"]): r["text"] for r in out.collect()} == expected


def test_empty_synonyms_change_nothing(spark, df):
    none = spark.createDataFrame([], "token string, synonym string")
    got = {r["id"]: r["text"] for r in A.substitute_words(df, "id", "text", none, 1, 1.0).collect()}
    assert got[2] == "only one" and got[1] == "One. Two. Three"


def test_failing_rows_are_left_out_and_counted(df):
    picky = A.Rewriter(lambda i, text, _p, copy: F.when(~((i == 2) & (copy == 2)), F.concat(text, copy.cast("string"))))

    out = A.augment_dataset(df, "id", "text", picky, 2).collect()
    assert sorted({r["id"] for r in out}) == [1, 3, 5] and len(out) == 6
    assert tuple(A.augment_counts(df, "id", "text", picky, 2).first()) == (5, 3)


def test_train_only(spark):
    rows = spark.createDataFrame([(1, "a. b", 1, 0, 0), (2, "c. d", 0, 1, 0)], "id int, text string, train int, test int, val int")
    out = A.augment_train(rows, "id", "text", A.shuffled_sentences(), 2, "label", 1).collect()
    assert [(r["id"], r["label"], r["train"], r["test"], r["val"]) for r in out] == [(1, 1, 1, 0, 0)] * 2


def test_long_and_short_lexicon_agree_on_repeated_ids(spark):
    rows = [(1, "one two three. two one"), (1, "three two one. one three two"), (1, "one two three. two one"), (None, "two two two"), (2, None)]
    df = spark.createDataFrame(rows, "id int, text string")
    synonyms = spark.createDataFrame([("one", "1"), ("two", "2"), ("three", "3")], "token string, synonym string")
    short, long = (A.substitute_words(df, "id", "text", synonyms, n=2, rate=0.6, max_literal=k).collect() for k in (10, 1))
    assert sorted(map(str, short)) == sorted(map(str, long)) and len(short) == 8
