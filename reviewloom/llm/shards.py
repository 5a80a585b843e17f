"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly, and equal texts stay together."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewloom.llm.base import n_words, query, table
from reviewloom.plans.session import cut_lineage

DIMENSIONS = ("size", "tokens", "rows")


#: What a dimension counts for when a shard is chosen; bytes are to come out near equal, also where a group of many
#: short copies has filled a shard's rows.
WEIGHTS = (64.0, 1.0, 1.0)
#: Rounds in which the capacities settle when single loads exceed them.
SETTLE = 4


def place(loads: np.ndarray, n_shards: int, weights: tuple[float, ...] = WEIGHTS) -> np.ndarray:
    """Shard of each load (rows of a matrix, one column per dimension).

    Loads come in order of their largest share of a shard. Each goes where the weighted dot product of its
    vector with the residual capacities is highest; the first shard wins a tie. A load beyond a shard's share of a
    dimension other than the first counts as one share, and the others share the rest of that dimension.
    """
    capacity = loads.sum(axis=0) / n_shards
    for _ in range(SETTLE):
        capacity[1:] = np.minimum(loads, capacity).sum(axis=0)[1:] / n_shards
    capacity = np.maximum(capacity, 1e-9)
    vectors = loads / capacity
    vectors[:, 1:] = np.minimum(vectors[:, 1:], 1)
    residual = np.ones((n_shards, loads.shape[1]))
    out = np.zeros(len(loads), np.int32)
    for k in np.lexsort((np.arange(len(loads)), -vectors.max(axis=1, initial=0))):
        shard = int(np.argmax(residual @ (vectors[k] * weights)))
        residual[shard] -= vectors[k]
        out[k] = shard
    return out


def assign_shards(
    docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", lots_per_shard: int = 256, rows_per_run: int = 20_000,
) -> DataFrame:
    """(id, size, tokens, text_crc32, shard, slot) of every row; slots count from 0 in each shard without a gap.

    The unit of packing is a lot. A group of equal texts that holds more than 1 / (n_shards * lots_per_shard) of
    the bytes, tokens or rows is a lot of its own, and one beyond a shard's whole capacity of bytes is split evenly
    by row; all other groups are gathered into as many lots by hash. So the driver packs a number of lots that
    depends on the shards alone, however large the table or a group is. Size is UTF-8 bytes plus 16; a null
    text has no bytes and the checksum of the empty text, and null texts are a group. Null and repeated ids and
    repeated rows all get slots of their own. Columns other than id and text are not read. Slots are numbered in
    runs of about ``rows_per_run`` rows per shard, whose offsets come from their counts.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    slim = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("bigint").alias("size"),
        n_words(text_col).alias("tokens"),
        F.lit(1).cast("bigint").alias("rows"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("bigint").alias("crc"),
        F.coalesce(F.unhex(F.md5(text.cast("binary"))), F.lit(b"")).alias("key"),
        F.monotonically_increasing_id().alias("row"),
    )
    slim = cut_lineage(slim, "shard-sizes")
    totals = slim.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in DIMENSIONS)).first()
    n_lots = n_shards * lots_per_shard
    groups = slim.groupBy("key").agg(*(F.sum(c).alias(c) for c in DIMENSIONS))
    share = F.greatest(*(F.col(c) / max(totals[c], 1) for c in DIMENSIONS))
    filled = (F.col("size") * n_shards / max(totals["size"], 1)).alias("filled")
    heavy = groups.select("key", share.alias("share"), filled).where(F.col("share") * n_lots > 1).orderBy("key").collect()
    pieces = [math.ceil(r.filled * 8) if r.filled > 1 else 1 for r in heavy]
    first = n_lots + np.concatenate(([0], np.cumsum(pieces)[:-1])) if heavy else []
    own = spark.createDataFrame(
        [(bytes(r.key), int(at), n) for r, at, n in zip(heavy, first, pieces, strict=True)], "key binary, first bigint, pieces bigint"
    )
    piece = F.pmod(F.xxhash64("id", "row"), F.col("pieces"))
    lot = F.coalesce(F.col("first") + piece, F.pmod(F.xxhash64("key"), F.lit(n_lots)))
    lotted = slim.join(F.broadcast(own), "key", "left").select("id", "row", "size", "tokens", "rows", "crc", lot.alias("lot"))
    loads = lotted.groupBy("lot").agg(*(F.sum(c).alias(c) for c in DIMENSIONS)).orderBy("lot").collect()
    homes = place(np.array([[r[c] for c in DIMENSIONS] for r in loads], float).reshape(-1, 3), n_shards)
    shards = spark.createDataFrame([(r.lot, int(s)) for r, s in zip(loads, homes, strict=True)], "lot bigint, shard int")

    runs = max(8, math.ceil(totals["rows"] / n_shards / rows_per_run))
    placed = lotted.join(F.broadcast(shards), "lot").withColumn("run", F.pmod(F.xxhash64("id", "row"), F.lit(runs)))
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "run").agg(F.count(F.lit(1)).alias("n"))
    offsets = offsets.select("shard", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("shard", "run").orderBy("id", "row"))
    numbered = placed.withColumn("rank", rank).join(offsets, ["shard", "run"])
    return numbered.select(
        F.col("id").alias(id_col), "size", "tokens", F.col("crc").alias("text_crc32"), "shard", (F.col("offset") + F.col("rank") - 1).alias("slot")
    )


@query("op1_shards")
def op1_shards(spark: SparkSession, folder: str) -> DataFrame:
    out = assign_shards(table(spark, folder, "documents"), 40)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "tokens"
    )
