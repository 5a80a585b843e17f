from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import metrics as M
from reviewloom.operators import train
from reviewloom.operators.sampling import assign_splits
from reviewloom.operators.search import Ledger, run_trials
from reviewloom.plans.session import shared_dir


@pytest.fixture(scope="module")
def datasets(spark):
    x = F.when(F.col("y") == 1, 1.0).otherwise(-1.0) + (F.hash("id") % 100) / 60.0
    df = spark.range(300).withColumn("y", (F.col("id") % 2).cast("int"))
    df = assign_splits(df.withColumn("v", F.array(x, (F.col("id") % 5).cast("double"))), "id")
    return {"pos": df.filter("y = 1"), "neg": df.filter("y = 0 and id < 200"), "more": df.filter("y = 0 and id >= 200")}


def search(datasets, scorer=None):
    return train.MixSearch(datasets, ["pos"], "logistic_regression", "y", "id", "v", trials=4, scorer=scorer, fixed={"max_iter": 5})


def rows(frame):
    return sorted((r.trial, r.score, r.n_rows, r.params, r.rows) for r in frame.collect())


def test_resumed_trials_equal_uninterrupted_ones(spark, datasets):
    seen = []

    def failing(df, y, p):
        seen.append(1)
        if len(seen) >= 3:
            raise RuntimeError("killed")
        return M.scorer("f1")(df, y, p)

    root = shared_dir(spark, "ledger")
    with search(datasets, failing) as s, pytest.raises(RuntimeError):
        run_trials(Ledger(spark, root), s, 1)
    later = Ledger(spark, root)
    assert later.session == 2 and len(later.pending(4)) == 2
    with search(datasets) as s:
        resumed = run_trials(later, s, 2)
    with search(datasets) as s:
        whole = run_trials(Ledger(spark, shared_dir(spark, "ledger")), s, 4)
    assert rows(resumed) == rows(whole) and later.pending(4) == []
    assert {r.session for r in resumed.collect()} == {1, 2}


def test_one_claim_and_one_commit(spark):
    ledger = Ledger(spark, shared_dir(spark, "ledger"))
    shared = Ledger(spark, ledger.root, session=ledger.session)
    with ThreadPoolExecutor(8) as threads:
        won = list(threads.map(lambda k: (ledger if k % 2 else shared).claim(7), range(16)))
    assert won.count(True) == 1
    row = {"trial": 7, "score": None, "n_rows": 3, "params": {"C": 1.0}, "rows": {"a": 2}}
    assert ledger.commit(row) and not shared.commit({**row, "score": 0.5})
    assert [(r.trial, r.score) for r in ledger.trials().collect()] == [(7, None)]


def test_other_settings_are_refused(spark):
    root = shared_dir(spark, "ledger")
    assert Ledger(spark, root).plan({"trials": 3, "versions": {"a": 1}})["versions"] == {"a": 1}
    assert Ledger(spark, root).plan({"trials": 3, "versions": {"a": 2}})["versions"] == {"a": 1}
    with pytest.raises(ValueError, match="trials"):
        Ledger(spark, root).plan({"trials": 4, "versions": {}})
