import datetime

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import metrics as M
from reviewloom.operators import submissions
from reviewloom.operators.tables import concat_datasets, fix_timeline, split_slice
from reviewloom.plans import session
from reviewloom.plans.session import cut_lineage, shared_dir
from reviewloom.sources import formats, runlog
from reviewloom.sources.registry import DatasetNotFound, Registry
from reviewloom.sources.runlog import RunLog

TEXTS = ['plain', 'quote " inside', "comma, and\nnewline\r\nend", "back\\slash \\n literal", "tab\t", " padded ", "ünï", "\\", "\\\\n"]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")


def test_registry(spark):
    registry = Registry(spark, shared_dir(spark, "registry"))
    assert registry.list_datasets() == []
    with pytest.raises(DatasetNotFound):
        registry.read_dataset("reviews")
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (3, "c")], "id int, text string")
    assert registry.write_dataset(df, "reviews") == 1
    assert registry.label_dataset("reviews", "y", 1) == 2
    assert registry.clean_dataset("reviews", "id", "text") == 3
    assert registry.split_dataset("reviews", "id") == 4
    assert registry.write_dataset(df, "other") == 1
    assert registry.list_datasets() == ["other", "reviews"] and registry.latest_version("reviews") == 4
    assert registry.read_dataset("reviews", 1).count() == 4
    assert set(registry.read_dataset("reviews").columns) == {"id", "text", "y", "train", "test", "val"}
    assert registry.versions("reviews") == [1, 2, 3, 4]
    with pytest.raises(DatasetNotFound):
        registry.read_dataset("reviews", 9)


def test_claims_are_never_shared(spark):
    registry = Registry(spark, shared_dir(spark, "registry"))
    assert [registry._claim("d"), registry._claim("d"), registry._claim("d")] == [1, 2, 3]
    assert registry.versions("d") == []


def test_generated(spark, texts):
    path = shared_dir(spark, "generated")
    formats.write_generated(texts, path)
    got = formats.read_generated(spark, path, label_col="y").collect()
    assert sorted(r["text"] for r in got) == sorted(TEXTS) and {r["y"] for r in got} == {1}
    odd = shared_dir(spark, "generated")
    spark.createDataFrame([('"fine"',), ("broken line",), ("",), ('  "spaced" ',)], "value string").write.text(odd)
    rows = formats.read_generated(spark, odd).collect()
    assert sorted((r["text"] or "", r["bad_line"] or "") for r in rows) == [("", "broken line"), ("fine", ""), ("spaced", "")]


def test_csv_and_lines(spark, texts):
    path = shared_dir(spark, "csv")
    formats.write_csv(texts, path)
    assert sorted(map(tuple, formats.read_csv(spark, path, texts.schema).collect())) == sorted(enumerate(TEXTS))
    path = shared_dir(spark, "lines")
    formats.write_lines(texts, "text", path)
    assert sorted(r["text"] for r in formats.read_lines(spark, path).collect()) == sorted(TEXTS)


def test_run_log(spark):
    log = RunLog(spark, shared_dir(spark, "runs"))
    pairs = spark.createDataFrame([(1, 1), (0, 1), (0, 0)], "y int, p int")
    for run, frame in (("r1", pairs), ("r2", pairs.filter("y = p"))):
        log.log_run(M.metrics_long(M.binary_metrics(frame, "y", "p"), run), run, "exp")
        log.log_attributes({"positive": ["a", "b"], "beta": 0.75, "model name": f"m-{run}"}, run, "exp", datetime.datetime(2024, 1, int(run[1])))
    assert log.attributes("r1") == {"positive": "a; b", "beta": "0.75", "model name": "m-r1"}
    best = runlog.leaderboard(log.read(), "f1").first()
    assert (best["run_id"], best["value"]) == ("r2", 1.0)
    assert [r["model"] for r in runlog.list_models(log.read()).collect()] == ["m-r2", "m-r1"]
    assert runlog.find_run(log.read(), run_id="r1").filter("name = 'fp'").first()["value"] == 1.0
    assert runlog.find_run(log.read(), experiment="nothing").count() == 0
    with pytest.raises(TypeError):
        log.log_run(spark.createDataFrame([("f1", "high")], "name string, value string"), "r3")


def test_dataset_versions_are_logged(spark):
    registry, log = Registry(spark, shared_dir(spark, "registry")), RunLog(spark, shared_dir(spark, "runs"))
    for name in ("a", "b", "b"):
        registry.write_dataset(spark.range(3), name)
    log.log_dataset_versions(registry, ["a", "b"], "r")
    assert log.attributes("r") == {"a_version": "1", "b_version": "2"}


def test_submissions(spark):
    data = [
        '{"Id": 1, "Status": "Published", "DateSubmitted": "2024-01-02T03:04:05+02:00", "Ratings": [{"Question": 10001, "Rating": 3}, {"Question": 10001, "Rating": 5}, {"Question": 10004, "Rating": 1}]}',
        '{"Id": 2, "Status": "Removed", "DateSubmitted": "2024-01-01"}',
        '{"Id": 3, "DateSubmitted": "2025-06-01 10:00:00", "Ratings": []}',
        '{"Id": 4, "Status": "Expired", "DateSubmitted": "soon", "Ratings": null}',
    ]
    df = spark.createDataFrame([(d,) for d in data], "Data string")
    for schema in (None, "Id bigint, Status string, DateSubmitted string, Ratings array<struct<Question:bigint,Rating:bigint>>"):
        out = submissions.load_submissions(df, schema=schema).collect()
        assert [r["Id"] for r in out] == [3, 1, 4]
        assert out[1]["DateSubmitted"] == datetime.datetime(2024, 1, 2, 3, 4, 5) and out[2]["DateSubmitted"] is None
        assert [out[1][f"Q_{q}"] for q in submissions.RATING_QUESTIONS] == [5, None, None, 1, None]
        assert out[0]["Q_10001"] is None and out[2]["Q_10001"] is None


def test_unreadable_payload(spark):
    df = spark.createDataFrame([('{"k": 1}',), ("oops",), (None,)], "Data string")
    assert [r["k"] for r in submissions.unpack_json(df, "Data", "k int").collect()] == [1, None, None]


def test_tables(spark):
    a = spark.createDataFrame([(1, 1, 0)], "id int, train int, test int")
    b = spark.createDataFrame([(2, 1)], "id int, val int")
    both = concat_datasets([a, b])
    assert set(both.columns) == {"id", "train", "test", "val"} and split_slice(both, "train").count() == 1
    assert split_slice(both, "all").count() == 2 and split_slice(both, ["train", "val"]).count() == 2
    assert concat_datasets([a, b], how="inner").columns == ["id"]
    for call in (lambda: split_slice(both, "holdout"), lambda: concat_datasets([]), lambda: concat_datasets([a], how="left")):
        with pytest.raises(ValueError):
            call()
    times = spark.createDataFrame([(1, "2024-01-01"), (2, None), (3, "2024-05-01 01:00:00Z")], "id int, t string")
    assert [r["id"] for r in fix_timeline(times, "t").collect()] == [3, 1, 2]


class FakeSession:
    def __init__(self, setting, master, checkpoint=None):
        self.made = []
        self.conf = {"spark.checkpoint.dir": setting}
        self.sparkContext = self
        self.master, self.checkpoint = master, checkpoint

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, path):
        self.checkpoint = path


def test_shared_folder_is_the_session_setting():
    assert session.shared_dir(FakeSession("hdfs://x/cp/", "yarn"), "t").startswith("hdfs://x/cp/t-")
    assert session.shared_dir(FakeSession(None, "yarn", "s3a://b/cp"), "t").startswith("s3a://b/cp/t-")
    with pytest.raises(RuntimeError):
        session.shared_dir(FakeSession(None, "yarn"), "t")
    local = FakeSession(None, "local[2]")
    first, second = session.shared_dir(local, "t"), session.shared_dir(local, "t")
    assert first != second and first.startswith(local.checkpoint) and second.startswith(local.checkpoint)


def test_cut_lineage(spark):
    df = cut_lineage(spark.range(5).withColumn("a", F.lit("b")), "t")
    assert df.count() == 5 and "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
