"""Stored answers of external models: what is sent, what is kept, and what a second call repeats."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import durable as D
from reviewloom.operators import external as X
from reviewloom.plans import bounded
from reviewloom.plans.session import shared_dir
from reviewloom.queries import stubs
from reviewloom.sources.registry import Registry


@pytest.fixture()
def registry(spark):
    return Registry(spark, shared_dir(spark, "answers"))


@pytest.fixture()
def log(tmp_path):
    return str(tmp_path)


def sent(log):
    return sorted(open(os.path.join(log, f)).read() for f in os.listdir(log))


def noter(log):
    """Writes each text to a file of its own; made in a function, as workers do not import test modules."""

    def note(text):
        with open(os.path.join(log, uuid.uuid4().hex), "w") as f:
            f.write(text)

    return note


def noting_encoder(log):
    note = noter(log)

    class Encoder(stubs.VowelEncoder):
        def encode(self, texts):
            for t in texts:
                note(t)
            return super().encode(texts)

    return Encoder


def noting_writer(log, refuse):
    note = noter(log)

    class Writer:
        def generate(self, prompt, n):
            note(prompt)
            if os.path.exists(refuse) and prompt.endswith("3"):
                raise RuntimeError("refused")
            return [f"{i}:{prompt}" for i in range(1, n + 1)]

    return Writer


def test_second_version_encodes_new_texts_only(spark, registry, log):
    first = spark.createDataFrame([(i, f"text {i % 7}") for i in range(40)] + [(99, None)], "id int, text string")
    out = D.embed_by_content(first, "id", "text", "v", noting_encoder(log), registry, wave_rows=3)
    plain = X.embed(first, "text", "v", stubs.VowelEncoder)
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect())) and out.columns == plain.columns
    assert sent(log) == sorted(f"text {i}" for i in range(7))
    second = first.union(spark.createDataFrame([(100, "new"), (101, "new"), (102, "text 1"), (None, "")], "id int, text string"))
    out = D.embed_by_content(second, "id", "text", "v", noting_encoder(log), registry)
    assert out.count() == 45 and out.filter("text = 'new'").select("embeddings_textv").distinct().first()[0] == [0, 1, 0, 0, 0]
    assert sent(log) == sorted([*(f"text {i}" for i in range(7)), "new", ""])
    D.embed_by_content(second, "id", "text", "w", noting_encoder(log), registry)
    assert len(sent(log)) == 9 * 2  # another model has its own store


def test_stopped_run_goes_on(spark, registry, log):
    rows = spark.createDataFrame([(i, f"p{i}") for i in range(50)], "prompt_id int, prompt string")
    store, writer = D.reply_store(registry, "replies"), noting_writer(log, "/nonexistent")

    def ask(texts):
        return X.generate(texts, writer, 2, "_key", "text")

    left = D.ask_new(rows, "prompt", store, ask, wave_rows=10, max_waves=2)
    early = sent(log)
    assert left == 3 and 0 < len(early) < 50 and len(registry.versions("replies")) == 2
    out = D.generate_durably(rows, writer, store, 2, wave_rows=10)
    whole = {(r.prompt_id, r.reply_no, r.text, r.error) for r in out.collect()}
    assert D.ask_new(rows, "prompt", store, ask) == 0
    assert sent(log) == sorted(f"p{i}" for i in range(50))  # each prompt once, over all calls
    assert whole == {(r.prompt_id, r.reply_no, r.text, r.error) for r in X.generate(rows, writer, 2).collect()} and len(whole) == 100


def test_unfinished_wave_does_not_count(spark, registry, log):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "prompt_id int, prompt string")
    store, writer = D.reply_store(registry, "replies"), noting_writer(log, "/nonexistent")

    def broken(texts):
        return X.generate(texts, writer, 1, "_key", "text").withColumn("error", F.raise_error(F.lit("driver lost")).cast("string"))

    with pytest.raises(Exception, match="driver lost"):
        D.ask_new(rows, "prompt", store, broken, tasks=1)
    assert store.rows().count() == 0
    assert {r.text for r in D.generate_durably(rows, writer, store).collect()} == {"1:a", "1:b"}


def test_failures_are_sent_again(spark, registry, log, tmp_path_factory):
    refuse = str(tmp_path_factory.mktemp("switch") / "refuse")
    open(refuse, "w").close()
    rows = spark.createDataFrame([(i, f"p{i % 5}") for i in range(20)], "prompt_id int, prompt string")
    store, writer = D.reply_store(registry, "replies"), noting_writer(log, refuse)
    bad = D.generate_durably(rows, writer, store).filter("error is not null").collect()
    assert {r.prompt_id for r in bad} == {3, 8, 13, 18} and all("refused" in r.error and r.text is None for r in bad)
    assert D.generate_durably(rows, writer, store).filter("error is not null").count() == 4  # last failure, once
    os.rename(refuse, refuse + "-off")
    good = D.generate_durably(rows, writer, store)
    assert good.count() == 20 and good.filter("error is not null").count() == 0
    assert sorted(sent(log)) == sorted(["p0", "p1", "p2", "p4"] + ["p3"] * 3)


def test_same_text_in_two_versions_counts_once(spark, registry):
    store = D.reply_store(registry, "replies")
    row = spark.createDataFrame([(bytearray(b"k"), 1, "x", None)], store.schema)
    store.append(row)
    store.append(row.withColumn("text", F.lit("y")))
    assert [(r.text, r.version) for r in store.current().collect()] == [("x", 1)]


def test_empty_input(spark, registry, log):
    none = spark.createDataFrame([], "id int, text string, version int, error string")
    out = D.embed_by_content(none, "id", "text", "v", noting_encoder(log), registry)
    assert out.columns == [*none.columns, "embeddings_textv"] and out.count() == 0 and sent(log) == []


def test_clashing_names(spark, registry):
    df = spark.createDataFrame([(1, "a", "x", 5, b"z")], "id int, text string, error string, version int, _key binary")
    row = D.embed_by_content(df, "id", "text", "v", stubs.VowelEncoder, registry).first()
    assert (row.error, row.version, bytes(row._key), row.embeddings_textv) == ("x", 5, b"z", [1, 0, 0, 0, 0])


def test_join_by_key_spreads_hot_keys(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    big = spark.range(5000).select("id", key.alias("k"))
    small = spark.createDataFrame([("hot", 1), ("7", 2), ("nowhere", 3)], "k string, v int")
    counts = big.filter("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = big.join(small, "k", how)
        dealt = bounded.join_by_key(big, small, "k", counts, how, ["id"]).select(*plain.columns)
        assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
