import pytest

from reviewloom.operators import external as X
from reviewloom.plans.session import shared_dir
from reviewloom.queries import stubs
from reviewloom.sources.registry import Registry


@pytest.fixture(scope="module")
def prompts(spark):
    return spark.createDataFrame([(f"p{i}", f"prompt {i}") for i in range(60)], "prompt_id string, prompt string")


def refused(text):
    return stubs._digit(text) == "f"


def test_generate(prompts):
    rows = X.generate(prompts, stubs.EchoWriter, n=3, concurrency=4).collect()
    good = {(r["prompt_id"], r["reply_no"]): r["text"] for r in rows if r["error"] is None}
    bad = [r for r in rows if r["error"]]
    texts = {f"p{i}": f"prompt {i}" for i in range(60)}
    assert good == {(k, n): f"{n}|{t}" for k, t in texts.items() if not refused(t) for n in (1, 2, 3)}
    assert {r["prompt_id"] for r in bad} == {k for k, t in texts.items() if refused(t)} and bad
    assert all(r["text"] is None and "refused" in r["error"] for r in bad)


def test_retries_stop_after_the_last_attempt(spark, prompts):
    def digit(t):
        return stubs._digit(t)

    few = {r["prompt_id"] for r in X.generate(prompts, stubs.FlakyWriter, attempts=2, wait=0).filter("error is not null").collect()}
    many = {r["prompt_id"] for r in X.generate(prompts, stubs.FlakyWriter, attempts=5, wait=0).filter("error is not null").collect()}
    assert few == {f"p{i}" for i in range(60) if digit(f"prompt {i}") in "012f"}
    assert many == {f"p{i}" for i in range(60) if digit(f"prompt {i}") == "f"}


def test_replies_to_a_large_batch_in_little_memory():
    """One batch of long prompts: neither they nor their replies are all held as Python objects."""
    import tracemalloc
    from concurrent.futures import ThreadPoolExecutor

    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"k": list(range(4000)), "p": [f"{i:>10000}" for i in range(4000)]})
    keys = []
    with ThreadPoolExecutor(2) as pool:
        tracemalloc.start()
        for part in X._replies(iter([batch, batch.slice(0, 0)]), lambda p: ([p, None], None) if p[-1] != "7" else (None, "E: no"), pool, 2):
            for row in part.to_pylist() if len(keys) < 200 else ():
                want = (row["reply_no"], row["text"], row["error"])
                assert want in ((1, f"{row['k']:>10000}", None), (2, None, None), (0, None, "E: no")) and list(row) == ["k", "reply_no", "text", "error"]
            keys.extend(part.column(0).to_pylist())
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
    assert keys == [k for k in range(4000) for _ in range(1 if k % 10 == 7 else 2)]
    assert peak < 10e6  # the prompts are 40 MB


@pytest.mark.parametrize(
    "ids", ["nullif(id, 2L)", "encode(string(id), 'utf-8')", "timestamp_micros(id * 1000001)", "cast(id as decimal(20,2))", "date_add(date'2020-01-01', int(id))"]
)
def test_ids_keep_their_type(spark, ids):
    df = spark.range(5).selectExpr(f"{ids} as id", "string(id) as prompt")
    out = X.generate(df, stubs.EchoWriter, id_col="id")
    assert out.schema["id"].dataType == df.schema["id"].dataType
    want = sorted(str((r["id"], f"1|{r['prompt']}")) for r in df.collect() if not refused(r["prompt"]))
    assert sorted(str((r["id"], r["text"])) for r in out.filter("error is null").collect()) == want


def test_retrying_keeps_no_prompts():
    writer = stubs.FlakyWriter()
    for i in range(2000):
        prompt = f"{i} " + "x" * 100
        for _ in range(5):
            try:
                assert writer.generate(prompt, 1) == [f"plain: {prompt}"] and not refused(prompt)
                break
            except TimeoutError:
                pass
        else:
            assert refused(prompt)
    held = [vars(writer), vars(writer.__dict__.get("last", writer))]
    assert all(len(v) < 2000 for h in held for v in h.values() if hasattr(v, "__len__"))


def test_waves_bound_what_one_task_reads(spark, prompts, monkeypatch):
    """Beyond the bytes of a wave no more tasks call, but each takes part of one wave only."""
    from pyspark import TaskContext

    class Sited:
        """Tells the task that took a prompt."""

        def __init__(self):
            self.site = f"{TaskContext.get().stageId()}.{TaskContext.get().partitionId()}"

        def generate(self, prompt, n):
            return [self.site] * n

    plain = sorted(map(str, X.generate(prompts, stubs.EchoWriter, n=2, concurrency=3).collect()))
    monkeypatch.setattr(X, "WAVE_BYTES", 200)
    assert sorted(map(str, X.generate(prompts, stubs.EchoWriter, n=2, concurrency=3).collect())) == plain
    taken = {}
    for r in X.generate(prompts, Sited, concurrency=3).collect():
        taken.setdefault(r["text"], set()).add(r["prompt_id"])
    stages = [t.split(".")[0] for t in taken]
    assert sum(map(len, taken.values())) == 60 and max(map(len, taken.values())) < 20
    assert len(set(stages)) > 1 and max(map(stages.count, stages)) <= 3


def test_rewrite_dataset_quarantines(spark):
    registry = Registry(spark, shared_dir(spark, "registry"))
    df = spark.createDataFrame([(i, f"text {i}") for i in range(40)] + [(99, None)], "id int, text string")
    registry.write_dataset(df, "reviews")
    name, failed = X.rewrite_dataset(registry, "reviews", stubs.FlakyWriter, "id", "text", "complaint", wait=0)
    good = registry.read_dataset(name).collect()
    assert name == "reviews_lowered" and {r["complaint"] for r in good} == {1}
    assert {r["id"] for r in good} | {r["id"] for r in failed.collect()} == set(range(40))
    assert {r["id"] for r in failed.collect()} == {i for i in range(40) if refused(f"text {i}")}


def test_score_external(spark):
    values = [None, "", "1234567", "abc", "x" * 2000]
    df = spark.createDataFrame(list(enumerate(values)), "id int, text string")
    rows = {r["id"]: r for r in X.score_external(df, stubs.LengthScorer, "text", batch_size=2).collect()}
    assert [rows[i]["label"] for i in range(5)] == [None, None, None, "short", "long"]
    assert rows[3]["probability"] == 0.25 and rows[2]["probability"] is None


def test_embed(spark):
    df = spark.createDataFrame([(1, "aei"), (2, None), (3, "oo")], "id int, text string")
    out = X.embed(df, "text", "vowels", stubs.VowelEncoder)
    name = X.embedding_column("text", "vowels")
    assert name == "embeddings_textvowels"
    assert {r["id"]: r[name] for r in out.collect()} == {1: [1, 1, 1, 0, 0], 2: None, 3: [0, 0, 0, 2, 0]}
    assert X.embed(out, "text", "vowels", stubs.VowelEncoder) is out
    assert X.embed(out, "text", "vowels", stubs.VowelEncoder, override=True) is not out
    prefixed = X.embed(df, "text", "intfloat/e5-large-v2", stubs.VowelEncoder)
    assert prefixed.filter("id = 1").first()[-1] == [1, 2, 1, 0, 1]  # "query: " brings a u and an e


def test_embed_dataset(spark):
    registry = Registry(spark, shared_dir(spark, "registry"))
    registry.write_dataset(spark.createDataFrame([(1, "a b")], "id int, text string"), "d")
    encoders = {"v": stubs.VowelEncoder, "s": stubs.SpaceEncoder}
    assert X.embed_dataset(registry, "d", "text", encoders) == 2
    assert X.embed_dataset(registry, "d", "text", encoders) is None
    row = registry.read_dataset("d").first()
    assert row["embeddings_textv"] == [1, 0, 0, 0, 0] and row["embeddings_texts"] == [1, 0, 0]


def test_llm_classify_shapes(spark):
    class Numbered:
        def generate(self, prompt, n):
            return ['{"output": "2"}]' if prompt.startswith("Rate. Input: 'fine'") else prompt] * n

    df = spark.createDataFrame([(1, 0, "fine", 1), (2, 1, "fine", 0)], "id int, y int, text string, test int")
    out = X.llm_classify([df], "y", "id", "text", Numbered, "Rate. ", mode="general", split="test")
    row = out.collect()
    assert len(row) == 1 and row[0]["prediction"] == 2
    everything = X.llm_classify([df], "y", "id", "text", Numbered, "Rate. ", mode="chat", split="all", n_to_sample=1)
    assert [(r["reply"], r["prediction"]) for r in everything.collect()] == [("Rate. fine", 3)]


def test_endpoint_request():
    plain = X.EndpointDetails("a", "https://example.org", content_field="inputs")
    assert plain.request("hi") == {"inputs": "hi"}
    assert X.EndpointDetails("a", "u", content_in_list=True).request("hi") == {"data": ["hi"]}
