"""Every stage of the pipeline over rows with planted cases, against what brute force and the plan of the rows say."""

import random

import corpus_pipeline
import pytest
from test_pairs import brute_components

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rnd = random.Random(8)
    words = ["".join(rnd.choice("aeioubcdlnrst") for _ in range(rnd.randint(3, 8))) for _ in range(500)]
    prose = lambda n: [rnd.choice(words) for _ in range(n)]
    clean = {d: " ".join(prose(40)) for d in range(300)}
    toxic = {1000 + d: " ".join([*prose(20), rnd.choice(["zukkon", "wexxan"]), *prose(20)]) for d in range(120)}
    near = {2000 + d: " ".join([*clean[d].split(), "tail"]) for d in range(0, 40)}
    copies = {3000 + d: clean[0] for d in range(30)}
    items = [" ".join(prose(15)) for _ in range(6)]
    leaks = {4000 + d: " ".join([*prose(20), items[d % 6].upper(), *prose(20)]) for d in range(18)}
    odd = {5000: None, 5001: "", 5002: " \n ", 5003: " ".join(prose(30_000))}
    texts = clean | toxic | near | copies | leaks | odd
    rows = [(d, t, "en", None if d % 7 == 0 else f"s{d % 3}", None) for d, t in texts.items()]
    folder = str(tmp_path_factory.mktemp("planted"))
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    marks = [(d, int(d in toxic)) for d in [*clean, *toxic]] + [(None, 1), (5, None)]
    spark.createDataFrame(marks, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([*enumerate(items), (9, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return {"folder": folder, "texts": texts, "clean": clean, "toxic": toxic, "leaks": leaks}


def test_stages_take_effect_and_keep_columns(spark, planted):
    docs = spark.read.parquet(f"{planted['folder']}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, planted["folder"])
        if name != "sharding":
            assert out.columns == docs.columns
            path = f"{planted['folder']}/{name}"
            out.write.parquet(path)
            docs = spark.read.parquet(path)
            left[name] = [r.doc_id for r in docs.select("doc_id").collect()]
        else:
            shards = out.toPandas()
    ids = set(planted["texts"])
    assert sorted(left["toxicity"]) == sorted(ids - set(planted["toxic"]))
    rows = [(d, planted["texts"][d]) for d in left["toxicity"]]
    assert sorted(left["near_duplicates"]) == sorted(d for d, c in brute_components(rows, 5).items() if d == c)
    assert sorted(left["decontamination"]) == sorted(set(left["near_duplicates"]) - set(planted["leaks"]))
    assert set(left["mixing"]) <= set(left["decontamination"]) and max(map(left["mixing"].count, set(left["mixing"]))) <= 2
    assert sorted(shards.doc_id) == sorted(left["mixing"]) and shards.shard.between(0, corpus_pipeline.SHARDS - 1).all()
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in shards.groupby("shard"))


def test_run_equals_the_stages_and_repeats(spark, planted):
    first, again = (sorted((r.doc_id, r.shard) for r in corpus_pipeline.run(spark, planted["folder"]).collect()) for _ in range(2))
    assert first == again and {d for d, _ in first} <= set(planted["clean"]) | {5003}


def test_empty_tables(spark, planted, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{planted['folder']}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
