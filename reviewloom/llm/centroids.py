"""Centroid clustering in exact integers: the threshold algorithm over sorted centroid lists finds the nearest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.base import query, table
from reviewloom.plans.session import cut_lineage

#: Components stay below this, so that squared distances and the sums of one task stay exact in 64 bits.
LARGEST = 1 << 27
#: Numbers that all centroids may have together, as they are sent to every task.
MOST_CENTROID_NUMBERS = 4_000_000
#: Entries of the table of (vector, centroid) pairs seen that one step of the walk holds.
SEEN_AT_ONCE = 8_000_000


def fixed_point(vector: Column, dims: int, scale: int) -> Column:
    """floor(scale * x) of each component as int; null unless there are ``dims`` finite ones."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    scaled = lambda x: F.floor(x.cast("double") * scale)
    wide = F.exists(vector, lambda x: F.abs(x.cast("double") * scale) >= LARGEST)
    fail = F.raise_error(F.lit(f"a vector component is beyond {LARGEST} / {scale}, where distances leave 64 bits")).cast("array<int>")
    good = (F.size(vector) == dims) & finite
    return F.when(good & wide, fail).when(good, F.transform(vector, lambda x: scaled(x).cast("int")))


class CentroidLists:
    """One sorted list of centroid values per dimension, widest spread first."""

    def __init__(self, centroids: np.ndarray):
        self.c = centroids
        k, dims = centroids.shape
        self.order = np.argsort(centroids, axis=0, kind="stable")
        self.values = np.take_along_axis(centroids, self.order, axis=0)
        self.turn = np.argsort(self.values[0] - self.values[-1], kind="stable") if k else np.arange(dims)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid (smallest number of equals) and squared distance of each row."""
        step = max(1, SEEN_AT_ONCE // max(len(self.c), x.shape[1]))
        parts = [self._walk(x[a : a + step]) for a in range(0, len(x), step)] or [(np.zeros(0, np.int64),) * 2]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _walk(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The threshold algorithm, a dimension of all rows at a time.

        ``low`` and ``high`` are the next unread list entries below and above each vector's value. Whatever centroid a
        vector has not seen lies in no dimension nearer than the nearer of the two, so the sum of those squared gaps
        bounds its distance from below; a vector is done once that bound strictly exceeds its best exact distance.
        """
        (n, dims), k = x.shape, len(self.c)
        label, best = np.full(n, k, np.int64), np.full(n, np.iinfo(np.int64).max)
        high = np.empty((n, dims), np.int32)
        for d in range(dims):
            high[:, d] = np.searchsorted(self.values[:, d], x[:, d])
        low = high - 1
        rows, seen = np.arange(n), np.zeros((n, k), bool)

        def gaps(at: np.ndarray, d) -> tuple[np.ndarray, np.ndarray]:
            """Distance to the next entry below and above; -1 at a list's end."""
            lo, hi = low[at, d], high[at, d]
            return (
                np.where(lo >= 0, x[at, d] - self.values[np.maximum(lo, 0), d], -1),
                np.where(hi < k, self.values[np.minimum(hi, k - 1), d] - x[at, d], -1),
            )

        def frontier(down: np.ndarray, up: np.ndarray) -> np.ndarray:
            near = np.where((down < 0) | ((up >= 0) & (up < down)), up, down)
            return near * near

        edge = np.empty((n, dims), np.int64)
        for d in range(dims):
            edge[:, d] = frontier(*gaps(rows, d))
        bound, left, turn = edge.sum(axis=1), np.full(n, k), 0
        while len(rows):
            d = int(self.turn[turn % dims])
            turn += 1
            down, up = gaps(rows, d)
            some = (down >= 0) | (up >= 0)
            below = (down >= 0) & ((up < 0) | (down <= up))
            lo, hi = low[rows, d], high[rows, d]
            found = self.order[np.where(below, np.maximum(lo, 0), np.minimum(hi, k - 1)), d]
            low[rows, d], high[rows, d] = lo - (some & below), hi + (some & ~below)
            new = np.flatnonzero(some & ~seen[rows, found])
            at, c = rows[new], found[new]
            seen[at, c] = True
            left[at] -= 1
            gap = x[at] - self.c[c]
            dist = np.einsum("nd,nd->n", gap, gap)
            better = (dist < best[at]) | ((dist == best[at]) & (c < label[at]))
            at, c, dist = at[better], c[better], dist[better]
            label[at], best[at] = c, dist
            moved = frontier(*gaps(rows, d))
            bound[rows] += moved - edge[rows, d]
            edge[rows, d] = moved
            rows = rows[(left[rows] > 0) & (bound[rows] <= best[rows])]
        return label, best


def rows_of(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, dims)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> list[tuple[int, list[int]]]:
    """(rows, componentwise sum) of each centroid's vectors, as exact integers."""
    k, dims = centroids.shape
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, n, total = CentroidLists(shared.value), np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            x = rows_of(batch.column("v"), dims)
            label, _ = lists.nearest(x)
            n += np.bincount(label, minlength=k)
            np.add.at(total, label, x)
        cluster, dim = np.nonzero(np.repeat(n[:, None] > 0, dims, axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster), pa.array(dim), pa.array(n[cluster]), pa.array(total[cluster, dim])], names=["cluster", "dim", "n", "total"]
        )

    parts = vectors.select("v").mapInArrow(run, "cluster long, dim long, n long, total long")
    wide = lambda c: F.sum(F.col(c).cast("decimal(19,0)"))
    summed = parts.groupBy("cluster", "dim").agg(wide("n").alias("n"), wide("total").alias("total")).collect()
    shared.unpersist()
    out = [(0, [0] * dims) for _ in range(k)]
    for r in summed:
        out[r.cluster][1][r.dim] = int(r.total)
        out[r.cluster] = (int(r.n), out[r.cluster][1])
    return out


def cluster_vectors(
    vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, salt: int = 3, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part.

    Vectors with exactly ``dims`` components, none null or non-finite, become floor(``scale`` * x). Centroids start as
    the ``k`` vectors with the smallest sha256 of ``<salt>:<id>`` (fewer vectors: all of them). Each round assigns
    every vector to its nearest centroid, ties to the smaller number, and replaces a centroid with vectors by the
    componentwise floor of their mean; a round that moves nothing ends the loop, as all later ones would be the same.
    What comes to the driver is one sum per centroid and dimension, at most ``MOST_CENTROID_NUMBERS``; the work of a
    round is one pass of the vectors, which were written once and are read again by every round.

    Rows without an id take part; as centroids they come after all others. Rows with equal ids are clustered each, and
    start as centroids in order of their vectors. A component of 2**27 / ``scale`` or more fails the job, since a
    64-bit distance could not hold it; so does an inertia beyond 64 bits. An empty table gives no rows. Other columns
    are not read, so their names can't clash.
    """
    if k * dims > MOST_CENTROID_NUMBERS:
        raise ValueError(f"{k} centroids of {dims} numbers are beyond what every task can hold")
    spark = vectors.sparkSession
    slim = vectors.select(F.col(id_col).alias("id"), fixed_point(F.col(vector_col), dims, scale).alias("v")).where("v is not null")
    slim = cut_lineage(slim, "fixed-point")
    first = F.coalesce(F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")).cast("binary"), 256), F.lit("~"))
    centroids = np.array([r.v for r in slim.orderBy(first, "v").limit(k).select("v").collect()], np.int64).reshape(-1, dims)
    for _ in range(rounds if len(centroids) else 0):
        sums = _sums(slim, centroids)
        moved = np.array([[t // n for t in total] if n else old.tolist() for (n, total), old in zip(sums, centroids, strict=True)], np.int64)
        if (moved == centroids).all():
            break
        centroids = moved
    shared = spark.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = CentroidLists(shared.value)
        for batch in batches:
            label, best = lists.nearest(rows_of(batch.column("v"), dims))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(label.astype(np.int32)), pa.array(best)], names=["id", "cluster", "distance"])

    kind = vectors.schema[id_col].dataType.simpleString()
    assigned = cut_lineage(slim.mapInArrow(assign, f"id {kind}, cluster int, distance long"), "clusters")
    inertia = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(19,0)")).alias("s")).collect()}
    whole = sum(inertia.values())
    if whole >= 1 << 63:
        raise OverflowError("the inertia of all vectors does not fit in 64 bits")
    digest = lambda c: hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()
    per = spark.createDataFrame(
        [(c, s, whole, digest(centroids[c])) for c, s in inertia.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    out = assigned.join(F.broadcast(per), "cluster")
    return out.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(k: int, rounds: int, dims: int, scale: int, salt: int) -> str:
    """The same in DuckDB, one pair of steps per round."""
    away = f"list_sum(list_transform(generate_series(1, {dims}), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i])))::bigint"
    steps = [
        f"""q as materialized (select vec_id, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as v from embeddings
            where len(embedding) = {dims} and len(list_filter(embedding, lambda x: x is not null and isfinite(x::double))) = {dims})""",
        f"""c0 as materialized (select row_number() over (order by sha256('{salt}:' || vec_id::varchar), v) - 1 as k, v from q
            order by sha256('{salt}:' || vec_id::varchar), v limit {k})""",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""a{r} as materialized (select vec_id, v, b.k as k, b.d as d from (
                select q.vec_id, any_value(q.v) as v, min({{'d': {away}, 'k': c.k}}) as b from q, c{r} c group by q.vec_id))"""
        )
        if r < rounds:
            steps.append(
                f"""m{r} as materialized (select k, list((s - ((s % n) + n) % n) // n order by i) as v from (
                    select k, i, sum(v[i])::bigint as s, count(*) as n from a{r}, generate_series(1, {dims}) t(i) group by k, i) group by k)"""
            )
            steps.append(f"c{r + 1} as materialized (select c{r}.k, coalesce(m{r}.v, c{r}.v) as v from c{r} left join m{r} using (k))")
    return (
        "with " + ",\n".join(steps) + f"""
        select vec_id, k::int as cluster, d as distance, sum(d) over (partition by k)::bigint as cluster_inertia, sum(d) over ()::bigint as inertia,
            sha256(array_to_string(c.v, ',')) as centroid_sha256
        from a{rounds} a join c{rounds} c using (k)"""
    )


@query("op11_cluster_vectors", _sql(8, 10, 64, 1024, 3))
def op11_cluster_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return cluster_vectors(table(spark, folder, "embeddings"))
