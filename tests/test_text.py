import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewloom.functions import scores, text
from reviewloom.functions.vectors import all_close, argmax, softmax, top_class

MESSY = [
    "  Two  spaces   three    four  ",
    "line one\nline two\n",
    "tab\tand hard space ​ zero",
    "ÀÉÎ Straße ÇA\x1c",
    "",
    " \n\t ",
    None,
    "a. b.. c . ",
    "no stop",
    " 　ends ",
]


def rows(spark, values, col="text"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, {col} string")


def column(df, expr):
    return [r[0] for r in df.orderBy("id").select(expr).collect()]


def python_clean(s):
    s = s.strip()
    for run in ("  ", "   "):
        s = re.sub(run, " ", s)
    return re.sub("\n", "", s).lower()


def test_clean_text_matches_python(spark):
    got = column(rows(spark, MESSY), text.clean_text("text"))
    assert got == [None if v is None else python_clean(v) for v in MESSY]


def test_word_count_matches_split(spark):
    got = column(rows(spark, MESSY), text.word_count("text"))
    assert [g for g, v in zip(got, MESSY) if v is not None] == [len(v.split()) for v in MESSY if v is not None]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=" \t\n\x0b\x1cab.é  ​‰　Z", max_size=30), min_size=1, max_size=20))
def test_clean_and_count_on_random_text(spark, values):
    df = rows(spark, values)
    assert column(df, text.clean_text("text")) == [python_clean(v) for v in values]
    assert column(df, text.word_count("text")) == [len(v.split()) for v in values]
    assert column(df, F.size(text.sentences("text"))) == [len([s for s in v.split(".") if s.strip()]) for v in values]


def test_sentences_keep_their_text(spark):
    assert column(rows(spark, ["a. b.. c . "]), text.sentences("text")) == [["a", " b", " c "]]


def test_tokens_and_ngrams(spark):
    df = rows(spark, ["The cat's hat, 2 ÉTÉ", "one", ""])
    words = df.select("id", text.tokens("text", ["the"]).alias("w"))
    assert column(words, F.col("w")) == [["cat", "s", "hat", "été"], ["one"], []]
    assert column(words, text.ngrams("w", 2)) == [["cat s", "s hat", "hat été"], [], []]
    assert column(words, text.ngrams("w", 3)) == [["cat s hat", "s hat été"], [], []]


def test_template(spark):
    df = rows(spark, ["GP"]).withColumn("n", F.lit(5))
    assert column(df, text.fill_template("At {text}: {n} {{words}}", {"text": "text", "n": "n"})) == ["At GP: 5 {words}"]
    with pytest.raises(KeyError):
        text.fill_template("At {missing}", {"text": "text"})


def test_parse_reply(spark):
    replies = ["Label 0 and Label 1", "It is Label 2, not Label 1", "nothing", None, "label 1"]
    assert column(rows(spark, replies), text.parse_reply("text", "chat")) == [1, 2, 3, None, 3]
    raw = ['["x: 1"]}', 'ab', '["x: y"]}', None]
    assert column(rows(spark, raw), text.parse_reply("text", "general")) == [1, None, None, None]
    with pytest.raises(ValueError):
        text.parse_reply("text", "other")


def test_score_json(spark):
    df = spark.createDataFrame([(0, "1", 0.5)], "id int, label string, p double")
    once = df.select("id", scores.encode_score("label", "p").alias("x"))
    twice = df.select("id", scores.encode_score("label", "p", double_encoded=True).alias("x"))
    assert column(once, F.col("x")) == ['{"0":"1","1":"0.5"}']
    assert column(twice, F.col("x")) == ['"{\\"0\\":\\"1\\",\\"1\\":\\"0.5\\"}"']
    for d in (once, twice):
        assert tuple(column(d, scores.decode_score("x"))[0]) == ("1", 0.5)
    bad = rows(spark, ["not json", None])
    assert [tuple(r) for r in column(bad, scores.decode_score("text"))] == [(None, None), (None, None)]


def test_json_strings(spark):
    values = ['quote " and \\ back', "new\nline", "ünï", ""]
    df = rows(spark, values)
    assert column(df, scores.decode_json_string(scores.json_string("text"))) == values
    assert column(rows(spark, ['"ok"', "broken", '"open', '{"v": 1}']), scores.decode_json_string("text")) == ["ok", None, None, None]


def test_severity(spark):
    names = ["Strongly Concerning", "Possibly Concerning", "No safeguarding", "??", None]
    assert column(rows(spark, names), scores.severity("text")) == [2, 1, 0, 0, 0]


def test_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 3.0, 2.0]), (1, [1000.0, 1000.0])], "id int, x array<double>")
    assert [sum(v) for v in column(df, softmax("x"))] == pytest.approx([1.0, 1.0])
    assert column(df, argmax("x")) == [1, 0]
    assert [r["probability"] for r in column(df, top_class("x"))] == pytest.approx([0.665241, 0.5], abs=1e-6)
    assert column(df, top_class("x", from_logits=False)["probability"]) == [3.0, 1000.0]


def test_all_close_is_relative_to_the_fresh_side(spark):
    pairs = [
        ([1.0, 2.0], [1.0, 2.0]),
        ([1.0], [1.0 + 9e-6]),
        ([0.0], [1e-8]),
        ([1e-8 + 2e-9], [0.0]),
        ([1.0], [1.0, 2.0]),
        (None, [1.0]),
        ([None], [1.0]),
    ]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "id int, a array<double>, b array<double>")
    assert column(df, all_close("a", "b")) == [True, True, True, False, False, False, False]
