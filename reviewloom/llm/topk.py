"""Exact top-k inner products: norm-sorted blocks, SVD-rotated partial sums, Cauchy-Schwarz residual bounds."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewloom.llm.base import query, table
from reviewloom.plans.session import cut_lineage

#: Relative slack of the floating-point bounds; what passes them is scored in integers.
SLACK = 1e-9
#: Share of pairs left from which a dense product is cheaper than following them one by one.
DENSE = 0.2


def quantized(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, or null if the vector or a component is null or not finite.

    A finite component so large that a product of two such vectors could leave 64 bits fails the job.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    wide = F.exists(vector, lambda x: F.abs(x.cast("double") * scale) * F.sqrt(F.size(vector)) >= F.lit(2.0**31))
    fail = F.raise_error(F.lit("a vector component is too large for exact 64-bit products")).cast("array<bigint>")
    return F.when(finite & wide, fail).when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint")))


def matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """Integer rows of a list column, padded with zeros to ``dims``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten(), np.int64)
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(n) for n in sizes] or [[]]).astype(int)] = flat
    return out


def exact_products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """All inner products as integers; by floating point where that is exact."""
    most = np.abs(q).max(initial=0) * float(np.abs(c).max(initial=0)) * q.shape[1]
    return (q.astype(float) @ c.T.astype(float)).astype(np.int64) if most < 2**53 else q @ c.T


class Rotated:
    """Vectors in rotated coordinates, with the length of what lies behind each stage."""

    def __init__(self, v: np.ndarray, rotation: np.ndarray, stages: list[int]):
        self.v = v
        self.r = v @ rotation
        tail = np.cumsum((self.r**2)[:, ::-1], axis=1)[:, ::-1]
        self.length = np.sqrt(tail[:, 0]) if v.shape[1] else np.zeros(len(v))
        self.rest = [np.sqrt(tail[:, s]) if s < v.shape[1] else np.zeros(len(v)) for s in stages]


def search_block(q: Rotated, q_ids: np.ndarray, least: np.ndarray, c: Rotated, c_ids: np.ndarray, k: int, stages: list[int], step: int = 1024) -> list[tuple]:
    """(query position, candidate position, score) of each query's k best candidates of a block.

    Candidates stand by descending length. ``least`` is what a score must reach for each query; it rises as
    candidates are found, and a query whose bound by length falls below it is done.
    """
    best: list[list[tuple[int, int, int]]] = [[] for _ in q_ids]
    least = least.copy()
    for a in range(0, len(c_ids), step):
        part = slice(a, a + step)
        rows = np.flatnonzero(q.length * c.length[a] * (1 + SLACK) + SLACK >= least)
        if not len(rows):
            break
        pairs, scores = None, None
        dots = q.r[rows][:, : stages[0]] @ c.r[part][:, : stages[0]].T
        alive = (dots + np.outer(q.rest[0][rows], c.rest[0][part])) * (1 + SLACK) + SLACK * np.outer(q.length[rows], c.length[part]) >= least[rows][:, None]
        if alive.mean() > DENSE:
            scores = exact_products(q.v[rows], c.v[part])
            pairs = np.nonzero(scores >= least[rows][:, None])
            scores = scores[pairs]
        else:
            i, j = np.nonzero(alive)
            dot = dots[i, j]
            for s, (low, high) in enumerate(zip(stages, [*stages[1:], q.v.shape[1]], strict=True)):
                if low >= high or not len(i):
                    continue
                dot = dot + np.einsum("nd,nd->n", q.r[rows[i], low:high], c.r[a + j, low:high])
                rest = q.rest[s + 1][rows[i]] * c.rest[s + 1][a + j] if s + 1 < len(stages) else 0.0
                keep = dot + rest + SLACK * (1 + q.length[rows[i]] * c.length[a + j]) >= least[rows[i]]
                i, j, dot = i[keep], j[keep], dot[keep]
            scores = np.einsum("nd,nd->n", q.v[rows[i]], c.v[a + j])
            pairs = (i, j)
        own = q_ids[rows[pairs[0]]] != c_ids[a + pairs[1]]
        i, j, scores = pairs[0][own], pairs[1][own], scores[own]
        order = np.lexsort((c_ids[a + j], -scores, i))
        i, j, scores = i[order], j[order], scores[order]
        first = np.flatnonzero(np.concatenate(([True], i[1:] != i[:-1]))) if len(i) else np.zeros(0, int)
        place = np.arange(len(i)) - np.repeat(first, np.diff([*first, len(i)]))
        for x, y, score in zip(rows[i[place < k]].tolist(), (a + j[place < k]).tolist(), scores[place < k].tolist(), strict=True):
            best[x].append((-score, int(c_ids[y]), y))
        for x in np.unique(rows[i]).tolist():
            best[x] = sorted(best[x])[:k]
            if len(best[x]) == k:
                least[x] = max(least[x], -best[x][-1][0])
    return [(x, y, -s) for x, found in enumerate(best) for s, _, y in found]


def rotation_of(sample: np.ndarray) -> np.ndarray:
    """Orthogonal matrix whose leading columns carry most of the sample's length."""
    if not len(sample):
        return np.eye(sample.shape[1])
    _, _, vt = np.linalg.svd(sample.T.astype(float) @ sample.astype(float), hermitian=True)
    return vt.T


def top_products(
    vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256,
    sample_rows: int = 5_000, probes: int = 1_000, block_rows: int = 4_096, query_rows: int = 2_048, stages: tuple[int, ...] = (8, 16, 32),
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the highest integer inner product for each query.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but the query's own id. Vectors
    become floor(scale * x). They are sorted by descending length, ties by hash, into blocks of ``block_rows``;
    the longest ``probes`` give every query a first bound, and with it the last block that can matter. Query
    blocks of ``query_rows`` meet only those blocks, and there the partial sums of the rotated vectors prune what
    can't reach the bound. The rotation comes from ``sample_rows`` vectors in hash order; any rotation gives the
    same rows. Scores are exact integers; a component of 2**31 / sqrt(dimensions) or more after scaling fails the job.

    Rows without id, null vectors and vectors with null or non-finite components take no part. A shorter vector
    counts as padded with zeros. A repeated query id is asked once, with its smallest vector; repeated
    candidates are ranked each. Ties go to the smaller id; with fewer than k candidates all are returned. An
    empty table gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    clean = vectors.select(F.col(id_col).cast("bigint").alias("id"), quantized(F.col(vector_col), scale).alias("v"))
    clean = clean.where(F.col("id").isNotNull() & F.col("v").isNotNull())
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    clean = clean.withColumn("norm2", norm)
    shape = clean.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims")).first()
    dims, n_blocks = shape.dims or 0, max(1, math.ceil(shape.n / block_rows))
    dealt = clean.repartitionByRange(n_blocks, F.desc("norm2"), F.xxhash64("id"), "id")
    sorted_ = cut_lineage(dealt.withColumn("block", F.spark_partition_id()).sortWithinPartitions(F.desc("norm2"), "id"), "norm-sorted")
    heads = {r.block: math.sqrt(r.most) for r in sorted_.groupBy("block").agg(F.max("norm2").alias("most")).collect()}
    n_blocks = max(heads, default=-1) + 1
    sample = sorted_.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").toArrow()
    longest = sorted_.orderBy(F.desc("norm2"), "id").limit(probes).select("id", "v").toArrow()
    cuts = sorted({s for s in stages if s < dims}) or [dims]
    shared = spark.sparkContext.broadcast(
        {"rotation": rotation_of(matrix(sample["v"], dims)), "ids": np.asarray(longest["id"]), "v": matrix(longest["v"], dims), "heads": [heads.get(b, 0.0) for b in range(n_blocks)]}
    )

    def bounds(batches):
        known = shared.value
        heads_ = np.maximum.accumulate(np.array(known["heads"])[::-1])[::-1]  # an empty block reaches as far as the next
        for batch in batches:
            q, ids = matrix(batch.column("v"), dims), np.asarray(batch.column("id"))
            scores = exact_products(q, known["v"]).astype(float)
            scores[ids[:, None] == known["ids"][None, :]] = -np.inf
            short = np.full((len(ids), max(0, k - scores.shape[1])), -np.inf)
            least = np.sort(np.concatenate((scores, short), axis=1), axis=1)[:, -k] if len(ids) else np.zeros(0)
            length = np.sqrt(np.asarray(batch.column("norm2"))) * (1 + SLACK)
            need = np.where(length > 0, (least - SLACK) / np.maximum(length, 1e-300), np.where(least <= SLACK, -np.inf, np.inf))
            last = np.maximum(np.searchsorted(-heads_, -need * (1 - SLACK * np.sign(need)), side="right") - 1, 0).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), pa.array(least), pa.array(last, pa.int32())], names=["id", "v", "least", "last"]
            )

    asked = sorted_.where(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("v", "norm2")).alias("q")).select("id", "q.v", "q.norm2")
    asked = cut_lineage(asked.mapInArrow(bounds, "id bigint, v array<bigint>, least double, last int"), "queries")
    n_query_blocks = max(1, math.ceil(asked.count() / query_rows))
    asked = asked.withColumn("qblock", F.pmod(F.xxhash64("id"), F.lit(n_query_blocks)).cast("int"))
    needs = spark.createDataFrame([(r.qblock, r.last) for r in asked.groupBy("qblock").agg(F.max("last").alias("last")).collect()], "qblock int, last int")
    wanted = needs.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("last")))).groupBy("block").agg(F.collect_list("qblock").alias("qblocks"))

    queries = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("last"))))
    offered = sorted_.join(wanted, "block").withColumn("qblock", F.explode("qblocks")).drop("qblocks")

    def search(q: pa.Table, c: pa.Table) -> pa.Table:
        found = []
        if q.num_rows and c.num_rows:
            c = c.sort_by([("norm2", "descending"), ("id", "ascending")])
            q_ids, c_ids = np.asarray(q["id"]), np.asarray(c["id"])
            rotation = shared.value["rotation"]
            found = search_block(
                Rotated(matrix(q["v"], dims), rotation, cuts), q_ids, np.asarray(q["least"]), Rotated(matrix(c["v"], dims), rotation, cuts), c_ids, k, cuts
            )
        columns = list(zip(*((int(q_ids[x]), int(c_ids[y]), s) for x, y, s in found), strict=True)) or [[], [], []]
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("query_id", "vec_id", "score"), columns, strict=True)})

    pairs = queries.groupBy("qblock", "block").cogroup(offered.groupBy("qblock", "block")).applyInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
  p as (select q.vec_id as query_id, c.vec_id,
      coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: coalesce(z[1] * z[2], 0))), 0)::bigint as score
    from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from p) where rank <= 5
"""


@query("op7_top_products", _SQL)
def op7_top_products(spark: SparkSession, folder: str) -> DataFrame:
    return top_products(table(spark, folder, "embeddings"))
