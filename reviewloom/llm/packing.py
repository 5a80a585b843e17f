"""Best-fit packing of token pieces: residual token, document and attention capacities select each bin."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewloom.llm.base import query, slices, table
from reviewloom.llm.units import unit_ids
from reviewloom.plans.session import cut_lineage

#: (rule, weights of tokens, documents, attention cost) that are tried; the fewest bins win, the first of equals.
RULES = (
    ("norm", (1.0, 0.0, 0.0)),
    ("norm", (1.0, 0.25, 0.25)),
    ("norm", (1.0, 0.0, 1.0)),
    ("dot", (1.0, 0.25, 0.25)),
)

Run = tuple[int, int, int, int, int]


def item(length: int) -> np.ndarray:
    """What a piece takes of a bin: tokens, one document, and length squared for attention within itself."""
    return np.array([length, 1, length * length], np.int64)


class Bins:
    """Open bins as states: bins with the same residual capacities are one row with their number ranges."""

    def __init__(self, capacity: np.ndarray):
        self.capacity = capacity
        self.rest = np.zeros((64, 3), np.int64)
        self.live = np.zeros(64, bool)
        self.at: dict[tuple, int] = {}
        self.ranges: list[list[tuple[int, int]]] = []
        self.opened = 0

    def add(self, rest: np.ndarray, first: int, n: int) -> None:
        if rest[0] < 1 or rest[1] < 1 or rest[2] < 1 or not n:
            return  # nothing fits any more
        key = tuple(rest.tolist())
        state = self.at.get(key)
        if state is None:
            state = self.at[key] = len(self.ranges)
            self.ranges.append([])
            if state == len(self.live):
                self.rest = np.concatenate((self.rest, np.zeros_like(self.rest)))
                self.live = np.concatenate((self.live, np.zeros_like(self.live)))
            self.rest[state] = rest
        self.live[state] = True
        self.ranges[state].append((first, n))

    def best(self, takes: np.ndarray, rule: str, weights: np.ndarray) -> int | None:
        """The state in which a piece goes: least residual norm left behind, or highest dot product with the residual."""
        n = len(self.ranges)
        fits = np.flatnonzero(self.live[:n] & (self.rest[:n] >= takes).all(axis=1))
        if not len(fits):
            return None
        share, need = self.rest[fits] / self.capacity, takes / self.capacity
        score = ((share - need) ** 2) @ weights if rule == "norm" else -(share @ (need * weights))
        return int(fits[np.argmin(score)])


def pack_lengths(counts: Mapping[int, int], tokens: int, documents: int, cost: int, rule: str, weights: tuple[float, ...]) -> tuple[list[Run], int]:
    """Best-fit decreasing over a histogram of lengths: (length, first rank, pieces, first bin, offset) and the bins.

    Pieces of one length differ in nothing that a bin sees, so they are placed in runs: the chosen state's bins are
    filled with as many of them as fit, all at once. The steps grow with the distinct lengths, not with the pieces.
    """
    capacity, bins, runs, w = np.array([tokens, documents, cost], np.int64), Bins(np.array([tokens, documents, cost])), [], np.array(weights)
    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        takes, left, rank = item(length), counts[length], 0

        def fill(rest: np.ndarray, first: int, n_bins: int, each: int) -> None:
            nonlocal rank, left
            for k in range(each):
                runs.append((length, rank, n_bins, first, int(tokens - rest[0] + k * length)))
                rank, left = rank + n_bins, left - n_bins
            bins.add(rest - each * takes, first, n_bins)

        while left:
            state = bins.best(takes, rule, w)
            rest = capacity if state is None else bins.rest[state].copy()
            most = int((rest // takes).min())
            if most < 1:
                raise ValueError(f"a piece of {length} tokens fits no bin")
            each = min(most, left)
            if state is None:
                first, n_bins = bins.opened, left // each
                bins.opened += n_bins
            else:
                first, there = bins.ranges[state].pop()
                n_bins = min(there, left // each)
                if n_bins < there:
                    bins.ranges[state].append((first + n_bins, there - n_bins))
                bins.live[state] = bool(bins.ranges[state])
            fill(rest, first, n_bins, each)
    return runs, bins.opened


def best_packing(counts: Mapping[int, int], tokens: int, documents: int, cost: int) -> tuple[list[Run], int]:
    """The packing of the rule with the fewest bins."""
    return min((pack_lengths(counts, tokens, documents, cost, rule, w) for rule, w in RULES), key=lambda x: x[1])


def token_pieces(docs: DataFrame, path: str, id_col: str, text_col: str, longest: int, end_id: int) -> DataFrame:
    """(id, row, piece, start, length, ids_crc32): every text as ids plus ``end_id``, cut where it is too long.

    All pieces but the first of a text have ``longest`` tokens. ``row`` tells rows with one id apart.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    end, width = np.uint32(end_id).astype("<u4").tobytes(), 4 * longest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = unit_ids(path)
        for batch in slices(batches, "text", 1 << 20):
            found = []
            for at, raw in enumerate(ids.encode(batch.column("text").to_pylist())):
                raw += end
                edge = (len(raw) - 1) % width + 1
                cuts = [0, *range(edge, len(raw) + 1, width)]
                found += [(at, k, a // 4, (b - a) // 4, zlib.crc32(raw[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
            at, piece, start, length, crc = (np.array(x, np.int64) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(at)), batch.column("row").take(pa.array(at)), *map(pa.array, (piece.astype(np.int32), start, length, crc))],
                names=["id", "row", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, row long, piece int, start long, length long, ids_crc32 long")


def pack_sequences(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokens: int = 1024, documents: int | None = None,
    cost: int | None = None, end_id: int = 2, rows_per_run: int = 20_000,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every text.

    A text is its token ids and then ``end_id``; only a text beyond ``longest`` = min(``tokens``, isqrt(``cost``))
    is cut. A sequence holds at most ``tokens`` tokens, ``documents`` pieces and ``cost`` of attention, the sum of
    squared lengths; by default the last two are as large as the first can need. Pieces are packed by best fit over
    the histogram of lengths, at most ``longest`` rows, which is all that reaches the driver; a piece then finds its
    place by its rank among those of its length. Ranks are taken in runs of about ``rows_per_run`` pieces, so a length
    that holds most of the table is spread like any other.

    Null and empty texts are one piece of one token. Rows with equal texts, equal ids or null ids are packed each. An
    empty table gives no rows. Other columns are not read, so their names can't clash.
    """
    documents = tokens if documents is None else documents
    cost = tokens * tokens if cost is None else cost
    longest = min(tokens, math.isqrt(cost))
    if longest < 1 or documents < 1:
        raise ValueError("a sequence must hold at least one token and one document")
    spark = docs.sparkSession
    pieces = cut_lineage(token_pieces(docs, path, id_col, text_col, longest, end_id), "pieces")
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs, _ = best_packing(counts, tokens, documents, cost)
    ordered = sorted(runs)
    shared = spark.sparkContext.broadcast(
        (np.array([(r[0] << 48) + r[1] for r in ordered], np.int64), np.array([(r[1], r[3], r[4]) for r in ordered], np.int64).reshape(-1, 3))
    )

    buckets = spark.createDataFrame([(k, max(1, math.ceil(n / rows_per_run))) for k, n in counts.items()], "length long, buckets long")
    dealt = pieces.join(F.broadcast(buckets), "length").withColumn("bucket", F.pmod(F.xxhash64("id", "row", "piece"), F.col("buckets"))).drop("buckets")
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    rank = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("id", "row", "piece"))
    ranked = dealt.withColumn("rank", rank).join(sizes, ["length", "bucket"]).withColumn("rank", F.col("first") + F.col("rank") - 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, found = shared.value
        for batch in batches:
            length, rank = (np.asarray(batch.column(c), np.int64) for c in ("length", "rank"))
            at = np.searchsorted(keys, (length << 48) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found[at, 1] + rank - found[at, 0]), pa.array(found[at, 2])],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    slim = ranked.select("id", "piece", "start", "length", "ids_crc32", "rank")
    placed = slim.mapInArrow(place, f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return placed.withColumnRenamed("id", id_col)


@query("op13_pack_sequences")
def op13_pack_sequences(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return pack_sequences(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
