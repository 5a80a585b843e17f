from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import moderate, terms
from reviewloom.plans import bounded

TEXTS = [
    (1, 1, "the good cat and the good dog saw the good cat"),
    (2, 0, "a bad cat, the bad dog"),
    (3, 1, "good"),
    (4, 0, ""),
    (5, 1, None),
]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(TEXTS, "id int, y int, text string")


@pytest.fixture(params=["broadcast", "salted"])
def size_check(request, monkeypatch):
    if request.param == "salted":
        monkeypatch.setattr(terms, "lookup_join", lambda *a, **k: bounded.lookup_join(*a, **{**k, "max_rows": 0}))


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_misspellings(spark, df, size_check):
    known = spark.createDataFrame([("good",), ("cat",), ("the",), ("the",)], "token string")
    assert rows(terms.misspellings(df, "id", "text", known), "id", "misspellings") == [(1, 3), (2, 3), (3, 0), (4, 0), (5, 0)]


def test_sentiment(spark, df, size_check):
    lexicon = spark.createDataFrame([("good", 1.0), ("bad", -0.5), ("dog", 0.0)], "token string, polarity double")
    got = rows(terms.lexicon_sentiment(df, "id", "text", lexicon), "id", "sentiment")
    assert got == [(1, 0.75), (2, pytest.approx(-1 / 3)), (3, 1.0), (4, 0.0), (5, 0.0)]


def test_tags(spark, df, size_check):
    tags = spark.createDataFrame([("good", "JJ"), ("bad", "JJ"), ("saw", "VBD")], "token string, tag string")
    assert rows(terms.tag_terms(df, "y", "text", tags), "tag", "n1", "n0") == [("JJ", 4, 2), ("VBD", 1, 0)]


def test_word_lists_are_lowered(spark):
    df = spark.createDataFrame([(1, "I will take Legal Action, Mary")], "id int, text string")
    rules = [moderate.keyword_rule("c", ["Legal Action"]), moderate.mentions_rule("m", ["Mary"]), moderate.lacks_rule("l", ["LEGAL"])]
    row = moderate.moderate(df, "text", rules).first()
    assert (row.c, row.m, row.l) == (1, 1, 0)


def test_modifiers(spark, df, size_check):
    mods = spark.createDataFrame([("good",), ("bad",)], "token string")
    assert rows(terms.modifier_pairs(df, "id", "text", mods), "id", "pos", "modifier", "head") == [
        (1, 1, "good", "cat"), (1, 5, "good", "dog"), (1, 9, "good", "cat"), (2, 1, "bad", "cat"), (2, 4, "bad", "dog"),
    ]


def test_distinctive_keeps_absent_or_frequent(spark):
    data = [(1, "aa bb")] * 4 + [(1, "cc dd")] * 4 + [(0, "cc dd")] * 2 + [(1, "ee ff")] * 5 + [(0, "ee ff")] * 4 + [(1, "gg hh")] * 3
    df = spark.createDataFrame(data, "y int, text string")
    got = [tuple(r) for r in terms.distinctive_ngrams(df, "y", "text", 2, threshold=3).collect()]
    assert got == [("aa bb", 4, 0, 4), ("ee ff", 5, 4, 1)]


def test_differences(spark):
    counts = spark.createDataFrame([("a", 9, 1), ("b", 0, 20), ("c", 3, 0), ("d", 2, 12)], "term string, n1 bigint, n0 bigint")
    assert [r["term"] for r in terms.freq_difference(counts, 2, "signed").collect()] == ["a", "c"]
    assert [r["term"] for r in terms.freq_difference(counts, 2, "abs").collect()] == ["d", "a"]
    with pytest.raises(ValueError):
        terms.freq_difference(counts, 2, "other")


def test_vocabulary(df):
    got = [tuple(r) for r in terms.vocabulary(df, "text", 3).collect()]
    assert got == [("good", 4), ("the", 4), ("cat", 3)]


def test_salted_join_spreads_and_matches(spark):
    big = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("k"))
    small = spark.createDataFrame([("hot", 1), ("7", 2), ("8", 3)], "k string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        salted = bounded.lookup_join(big, small, "k", how, ["id"], max_rows=0)
        plain = big.join(small, "k", how)
        assert Counter(map(str, salted.select(*plain.columns).collect())) == Counter(map(str, plain.collect()))


def test_spread_small(spark):
    df = spark.range(100).coalesce(1)
    assert bounded.spread_small(df, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(0, 100, 1, 64)
    assert bounded.spread_small(wide, "id") is wide


def test_bounded_rows(spark):
    assert len(bounded.bounded_rows(spark.range(5), 5)) == 5 and bounded.bounded_rows(spark.range(6), 5) is None
    assert bounded.fits_broadcast(spark.range(10), max_rows=10) and not bounded.fits_broadcast(spark.range(11), max_rows=10)
    long = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert not bounded.fits_broadcast(long, max_bytes=5000)
