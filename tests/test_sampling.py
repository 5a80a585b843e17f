import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import grids, sampling
from reviewloom.plans import hash_rank


def order(key, seed=42):
    return (hashlib.md5(f"{seed}|{key}".encode()).hexdigest(), key)


@pytest.fixture(scope="module")
def pool(spark):
    """A third of all rows is in one class; some labels are null."""
    data = [(i, "hot" if i % 3 == 0 else f"c{i % 7}" if i % 50 else None) for i in range(3000)]
    return spark.createDataFrame(data, "id bigint, y string")


def by_class(df):
    out = {}
    for r in df.filter("y is not null").collect():
        out.setdefault(r["y"], []).append(r["id"])
    return out


def test_balance_small_fixture(spark):
    df = spark.createDataFrame([(i, "red" if i < 3 else "blue") for i in range(11)], "id int, colour string")
    counts = Counter(r["colour"] for r in sampling.balance(df, "colour", "id").collect())
    assert counts == {"red": 3, "blue": 3}


def test_balance_is_the_first_rows_in_hash_order(pool):
    groups = by_class(pool)
    smallest = min(map(len, groups.values()))
    expected = {i for ids in groups.values() for i in sorted(ids, key=order)[:smallest]}
    assert {r["id"] for r in sampling.balance(pool, "y", "id").collect()} == expected


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_partitioning_does_not_matter(pool, parts):
    shuffled = pool.repartition(parts).sortWithinPartitions(F.rand(parts))
    assert {r["id"] for r in sampling.balance(shuffled, "y", "id").collect()} == {
        r["id"] for r in sampling.balance(pool, "y", "id").collect()
    }
    assert sorted(sampling.sample_n(shuffled, 37, "id").collect()) == sorted(sampling.sample_n(pool, 37, "id").collect())


def test_many_groups_take_the_shuffle_path(pool, monkeypatch):
    recipe = {"hot": 100, "c1": 5, "c2": 0, "c4": 10_000}
    usual = (
        sampling.balance(pool, "y", "id"),
        sampling.mix(pool, "y", recipe, "id"),
        sampling.stratified_split(pool, "y", "id", 0.3),
    )
    usual = [sorted(map(str, df.collect())) for df in usual]
    monkeypatch.setattr(hash_rank, "MAX_COUNTS", 3)
    other = (
        sampling.balance(pool, "y", "id"),
        sampling.mix(pool, "y", recipe, "id"),
        sampling.stratified_split(pool, "y", "id", 0.3),
    )
    assert usual == [sorted(map(str, df.collect())) for df in other]


def test_sample_is_the_first_rows_in_hash_order(pool):
    ids = sorted((r["id"] for r in pool.select("id").collect()), key=order)
    assert {r["id"] for r in sampling.sample_n(pool, 500, "id").collect()} == set(ids[:500])
    assert sampling.sample_n(pool, 10**6, "id").count() == pool.count()
    assert sampling.sample_n(pool, 0, "id").count() == 0


def test_null_and_repeated_keys_on_both_paths(spark, monkeypatch):
    rows = [(i % 700, "ab"[i % 2]) for i in range(3000)] + [(None, "a")] * 40 + [(5000 + i, "b") for i in range(300)]
    df = spark.createDataFrame(rows, "id int, y string")

    def results():
        frames = (
            sampling.balance(df, "y", "id"),
            sampling.mix(df, "y", {"a": 77, "b": "all"}, "id"),
            sampling.stratified_split(df, "y", "id", 0.3),
        )
        return [sorted(map(str, f.collect())) for f in frames]

    usual = results()
    monkeypatch.setattr(hash_rank, "MAX_COUNTS", 3)
    assert usual == results()


def test_repeated_keys_stay_together(spark):
    df = spark.createDataFrame([(1, "a")] * 500 + [(i, "a") for i in range(2, 12)], "id int, y string")
    ranked = sorted({1, *range(2, 12)}, key=order)
    taken = hash_rank.take_by_hash(df, "y", "id", {"a": 1})
    assert {r["id"] for r in taken.distinct().collect()} == {ranked[0]}


def test_splits(spark):
    df = spark.range(4000)
    out = sampling.assign_splits(df, "id", {"train": 0.6, "test": 0.3, "val": 0.1})
    r = out.agg(*[F.avg(c).alias(c) for c in ("train", "test", "val")], F.max(F.col("train") + F.col("test") + F.col("val")).alias("m")).first()
    assert r["m"] == 1 and r["train"] == pytest.approx(0.6, abs=0.03) and r["val"] == pytest.approx(0.1, abs=0.02)
    with pytest.raises(ValueError):
        sampling.assign_splits(df, "id", {"train": 0.6, "test": 0.3, "val": 0.2})


def test_mix(pool):
    got = by_class(sampling.mix(pool, "y", {"hot": "all", "c1": 7, "c2": 0}, "id"))
    groups = by_class(pool)
    assert sorted(got["hot"]) == sorted(groups["hot"])
    assert set(got["c1"]) == set(sorted(groups["c1"], key=order)[:7])
    assert "c2" not in got


def test_carve_is_disjoint_and_complete(spark):
    df = spark.range(2000).withColumn("y", (F.col("id") % 5 == 0).cast("int"))
    out = sampling.carve(df, "y", "id", validation=100, supplementary=300)
    parts = Counter((r["y"], r["part"]) for r in out.collect())
    assert out.count() == 2000 == out.select("id").distinct().count()
    assert parts == {
        (1, "validation"): 50, (1, "train"): 350, (0, "supplementary"): 300, (0, "train"): 350,
        (0, "validation"): 50, (0, "remainder"): 900,
    }
    assert out.filter("in_big_validation").count() == 1000


def test_holdout(spark):
    df = spark.range(200).withColumn("y", (F.col("id") % 4 == 0).cast("int"))
    plain = Counter(r["part"] for r in sampling.holdout(df, "y", "id", 20).collect())
    assert plain == {"validation": 20, "train": 180}
    balanced = Counter((r["y"], r["part"]) for r in sampling.holdout(df, "y", "id", 20, balance_rest=True).collect())
    assert balanced == {(1, "validation"): 10, (0, "validation"): 10, (1, "train"): 40, (0, "train"): 40, (0, "unused"): 100}


def test_stratified(pool):
    out = sampling.stratified_split(pool, "y", "id", 0.2)
    sizes = {g: len(ids) for g, ids in by_class(pool).items()}
    got = Counter(r["y"] for r in out.filter("is_val = 1").collect())
    assert got == {g: int(0.2 * n + 0.5) for g, n in sizes.items()}


def test_grid(spark):
    rows = grids.param_grid(spark, {"a": ["x", "y", "y"], "b": [1, 2]}).orderBy("grid_pos").collect()
    assert [(r["a"], r["b"]) for r in rows] == [("x", 1), ("x", 2), ("y", 1), ("y", 2), ("y", 1), ("y", 2)]
    assert grids.param_grid(spark, grids.COMPLAINTS_GRID).count() == 840
    assert grids.param_grid(spark, grids.NOT_EXPERIENCE_GRID).count() == 1176


def test_pending_runs_compare_beta_exactly(spark):
    plan = spark.createDataFrame([("m", "SVM", 0.5), ("m", "SVM", 0.55), ("m", "SVM", None)], "embedding string, classifier string, beta double")
    done = spark.createDataFrame([("m", "SVM", 0.55), ("m", "SVM", None)], plan.schema)
    assert [r["beta"] for r in grids.pending_runs(plan, done).collect()] == [0.5]


def test_experiment_list(spark):
    lines = spark.createDataFrame([("gte,SVM,0.75",), ("",), ("e5,xgboost",)], "value string")
    assert [tuple(r) for r in grids.read_experiment_list(lines).collect()] == [("gte", "SVM", 0.75), ("e5", "xgboost", None)]


@pytest.mark.parametrize("kind", sorted(grids.SEARCH_SPACES))
def test_search_spaces_stay_in_range(spark, kind):
    trials = spark.range(300).withColumnRenamed("id", "trial")
    df = grids.search_space(trials, "trial", kind)
    limits = {"C": (0.0001, 1000), "n_estimators": (100, 1000), "max_iter": (100, 1000), "subsample": (0.5, 1.0), "max_depth": (1, 100)}
    for name, (low, high) in limits.items():
        if name in df.columns:
            r = df.agg(F.min(name), F.max(name)).first()
            assert low <= r[0] <= r[1] <= high
    with pytest.raises(ValueError):
        grids.search_space(trials, "trial", "unknown")


def test_fewer_digits_give_the_same_rows(pool, monkeypatch):
    expected = sorted(map(str, sampling.stratified_split(pool, "y", "id", 0.3).collect()))
    for most in (60, 1):
        monkeypatch.setattr("reviewloom.plans.hash_rank.MAX_COUNTS", most)
        assert sorted(map(str, sampling.stratified_split(pool, "y", "id", 0.3).collect())) == expected


def test_shuffle_positions(spark, pool):
    """The places are those of the sorted order, whatever the partitions; repeated keys share one."""
    order = [r["id"] for r in sampling.shuffle(pool, "id").collect()]
    placed = sampling.shuffle_positions(pool.repartition(7), "id").collect()
    assert sorted((r["position"], r["id"]) for r in placed) == list(enumerate(order, 1))
    assert order != sorted(order)
    twice = sampling.shuffle_positions(spark.createDataFrame([(1,), (1,), (None,), (2,)], "id long"), "id").collect()
    assert sorted(r["id"] for r in twice) == [1, 1, 2]
    assert len({r["position"] for r in twice if r["id"] == 1}) == 1
