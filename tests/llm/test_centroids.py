import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException

from reviewloom.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, v string"


def brute(rows, k, rounds, dims, scale=1024, salt=3):
    """Plain k-means in Python integers."""
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = lambda r: (hashlib.sha256(f"{salt}:{r[0]}".encode()).hexdigest() if r[0] is not None else "~", r[1])
    c = [v for _, v in sorted(kept, key=first)[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def near(v):
        return min((dist(v, w), j) for j, w in enumerate(c))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        c = [[sum(x) // len(groups[j]) for x in zip(*groups[j], strict=True)] if j in groups else w for j, w in enumerate(c)]
    out = [(i, *near(v)[::-1]) for i, v in kept]
    part = {j: sum(d for _, x, d in out if x == j) for _, j, _ in out}
    sha = [hashlib.sha256(",".join(map(str, w)).encode()).hexdigest() for w in c]
    return sorted(((i, j, d, part[j], sum(part.values()), sha[j]) for i, j, d in out), key=str)


def as_float(v):
    return v if v is None else [None if x is None else float(np.float32(x)) for x in v]


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, centroids.cluster_vectors(df, **options).collect()), key=str)


@pytest.mark.parametrize("spread", [0.002, 1.0])
def test_equals_plain_k_means(spark, spread):
    rnd = random.Random(3)
    rows = [(i, as_float([rnd.gauss((i % 4) * spread, spread) for _ in range(6)])) for i in range(300)]
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1]), (900, None), (901, [1.0] * 5), (902, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (903, [float("nan")] * 6), (904, [float("inf")] * 6), (905, [])]
    assert run(spark, rows, k=8, rounds=10, dims=6) == brute(rows, 8, 10, 6)


def test_few_vectors_ties_and_none(spark):
    rows = [(i, [float(i % 2), 0.0]) for i in range(5)]
    assert run(spark, rows, k=8, rounds=3, dims=2) == brute(rows, 8, 3, 2)  # equal centroids: the smaller number wins, the others stay empty
    assert run(spark, [(1, None)], dims=2) == [] and run(spark, [], dims=2) == []


def test_walk_equals_all_distances_and_stops_early():
    rnd = np.random.default_rng(1)
    for k, dims, most in ((1, 3, 9), (40, 5, 9), (200, 16, 1000)):
        c, x = rnd.integers(-most, most, (k, dims)), rnd.integers(-most, most, (500, dims))
        label, best = centroids.CentroidLists(c).nearest(x)
        full = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        assert (best == full.min(axis=1)).all() and (label == full.argmin(axis=1)).all()
    far = np.arange(400)[:, None] * 1000 + np.zeros((400, 4), np.int64)
    lists, read = centroids.CentroidLists(far), []
    lists.order = type("Counted", (np.ndarray,), {"__getitem__": lambda s, at: (read.append(len(at[0])) if isinstance(at, tuple) else None, np.ndarray.__getitem__(s, at))[1]})((400, 4), buffer=lists.order.copy(), dtype=lists.order.dtype)
    assert (lists.nearest(far + 3)[0] == np.arange(400)).all()
    assert sum(read) < 400 * 10  # of 400 centroids each


def test_beyond_exact_range_fails(spark):
    with pytest.raises(PySparkException, match="beyond"):
        run(spark, [(1, [3.0e30, 1.0])], dims=2)
