"""Phrase mentions by trie and by joins, against a plain search."""

import random

import pytest

from reviewloom.operators import phrases

PATHS = {"trie": {}, "joins": {"max_rows": 0}}


@pytest.fixture(params=sorted(PATHS))
def path(request):
    return PATHS[request.param]


def plain(texts, gazetteer, longest):
    """Every place against every phrase, on the words themselves."""
    out = []
    for key, words in texts:
        free = 0
        for start in range(len(words)):
            found = [p for p in gazetteer if words[start : start + len(p.split())] == p.split()]
            if longest:
                found = [max(found, key=lambda p: len(p.split()))] if found and start >= free else []
                free = start + len(found[0].split()) if found else free
            out += [(key, start, e, p) for p in found for e in gazetteer[p]]
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("overlaps", phrases.OVERLAPS)
def test_same_as_plain_search(spark, path, overlaps):
    rng = random.Random(5)
    texts = [(i % 30, [rng.choice("abcd") for _ in range(rng.randrange(60))]) for i in range(50)]  # ids repeat
    texts.append((99, ["b", "a"] * 40))
    gazetteer = {" ".join(rng.choice("abcd") for _ in range(rng.choice([1, 2, 2, 3, 4, 6]))): ["X"] for _ in range(25)}
    gazetteer |= {" ".join(["b", "a"] * 30): ["LONG", "Y"], "a": ["X", "Z"]}
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in texts], "id int, text string")
    names = spark.createDataFrame([(p, e) for p, es in gazetteer.items() for e in es], "phrase string, entity string")
    got = rows(phrases.phrase_mentions(df, "id", "text", names, overlaps, **path))
    assert got == plain(texts, gazetteer, overlaps == "longest") and any(len(r[3].split()) == 60 for r in got)


def test_overlaps_and_capitals(spark, path):
    df = spark.createDataFrame([("k", "The New York Times, new york. A TIMES square")], "id string, text string")
    names = spark.createDataFrame(
        [("New  York", "LOC"), ("new york times", "ORG"), ("times square", "LOC"), ("times", "MISC"), ("new york", "LOC")], "phrase string, entity string"
    )
    assert rows(phrases.phrase_mentions(df, "id", "text", names, "longest", **path)) == [
        ("k", 1, "ORG", "new york times"), ("k", 4, "LOC", "new york"), ("k", 7, "LOC", "times square"),
    ]
    assert len(rows(phrases.phrase_mentions(df, "id", "text", names, "all", **path))) == 6


def test_names(spark, path):
    df = spark.createDataFrame([(1, "the good cat and the good dog saw the good cat"), (2, "a bad cat, the bad dog"), (3, "good")], "id int, text string")
    names = spark.createDataFrame([("cat", "PER"), ("good cat", "PER"), ("bad dog", "ORG"), ("dog saw the good", "LOC")], "phrase string, entity string")
    got = rows(phrases.phrase_mentions(df, "id", "text", names, **path))
    assert got == sorted(
        [(1, 1, "PER", "good cat"), (1, 2, "PER", "cat"), (1, 9, "PER", "good cat"), (1, 10, "PER", "cat"), (2, 2, "PER", "cat"), (2, 4, "ORG", "bad dog"),
         (1, 6, "LOC", "dog saw the good")]
    )
    capitals = spark.createDataFrame([("Good  CAT", "PER")], "phrase string, entity string")
    assert (1, 1, "PER", "good cat") in rows(phrases.phrase_mentions(df, "id", "text", capitals, **path))


@pytest.mark.parametrize("overlaps", phrases.OVERLAPS)
def test_odd_rows(spark, path, overlaps):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, "a b", 0), (None, "a b", 0), (3, "; 12", 0)], "id int, text string, start int")
    names = spark.createDataFrame([("a b", "E"), (None, "E"), ("", "E"), ("12", "E"), ("b", None)], "phrase string, entity string")
    got = [tuple(r) for r in phrases.phrase_mentions(df, "id", "text", names, overlaps, **path).collect()]
    both = [(None, 0, "E", "a b")] * 2 + ([(None, 1, None, "b")] * 2 if overlaps == "all" else [])
    assert sorted(got, key=str) == sorted(both, key=str)
    empty = phrases.phrase_mentions(df.limit(0), "id", "text", names, overlaps, **path)
    assert empty.collect() == [] and empty.columns == ["id", "start", "entity", "phrase"]
    assert phrases.phrase_mentions(df, "id", "text", names.limit(0), overlaps, **path).collect() == []


def test_many_mentions_leave_in_batches(spark, monkeypatch):
    monkeypatch.setattr(phrases, "OUT_ROWS", 7)
    df = spark.createDataFrame([(i, "a " * 20) for i in range(9)], "id int, text string")
    names = spark.createDataFrame([("a", "E"), ("a a", "E")], "phrase string, entity string")
    assert phrases.phrase_mentions(df, "id", "text", names).count() == 9 * 39


def test_unknown_overlaps(spark):
    with pytest.raises(ValueError):
        phrases.phrase_mentions(spark.createDataFrame([(1, "a")], "id int, text string"), "id", "text", None, "some")
