"""The index of text hashes: increments, replacement, leaks."""

import pytest

from reviewloom.operators.key_index import KeyIndex
from reviewloom.plans.session import shared_dir
from reviewloom.sources.registry import Registry


@pytest.fixture()
def index(spark):
    return KeyIndex(Registry(spark, shared_dir(spark, "index")))


@pytest.fixture()
def frame(spark):
    return lambda rows: spark.createDataFrame(rows, "id int, text string")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_leaks_of_a_new_batch(index, frame):
    index.add("train", "1", frame([(1, "a"), (2, "a"), (3, "b"), (4, None)]), "text")
    index.add("val", "1", frame([(5, "a"), (6, "c")]), "text")
    new = frame([(7, "a"), (7, "a"), (8, "b"), (9, "x"), (10, None), (11, "")])
    found = [(7, "train", 2), (7, "train", 2), (7, "val", 1), (7, "val", 1), (8, "train", 1)]
    assert rows(index.leaks("test", new, "id", "text")) == found
    index.add("test", "1", new, "text")
    assert rows(index.leaks("test", new, "id", "text")) == found  # its own entries do not count
    assert {(r.n_datasets, r.n) for r in index.shared().collect()} == {(3, 5), (2, 2)}


def test_batches_add_up_and_replace_themselves(index, frame):
    index.add("train", "1", frame([(1, "a")]), "text")
    index.add("train", "2", frame([(2, "a"), (3, "b")]), "text")
    assert sorted(r.n for r in index.datasets_of().collect()) == [1, 2]
    index.add("train", "2", frame([(2, "a"), (3, "b")]), "text")
    assert sorted(r.n for r in index.datasets_of().collect()) == [1, 2]
    index.add("train", "2", frame([(3, "b")]), "text")
    assert sorted(r.n for r in index.datasets_of().collect()) == [1, 1]
    assert index.batches() == [("train", "1"), ("train", "2")]


def test_hot_text_and_empty(index, frame):
    assert rows(index.leaks("test", frame([(1, "a")]), "id", "text")) == []
    index.add("train", "1", frame([(0, "hot"), (1, "t5")]), "text")
    new = frame([(i, "hot" if i % 3 == 0 else f"t{i}") for i in range(3000)])
    assert index.leaks("test", new, "id", "text").count() == 1001
    assert rows(index.leaks("test", frame([]), "id", "text")) == []


def test_names(index, frame):
    with pytest.raises(ValueError):
        index.add("a.b", "1", frame([(1, "a")]), "text")
