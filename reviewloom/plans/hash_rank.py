"""Exact sampling by hash order, without ordering or shuffling the sampled rows.

"The n rows of a class with the smallest hash" is the base of every sample, balance, split and carve-out
here. Ranking a class with one window would send the whole class, half of the table for a binary label,
through one task. Instead the n-th smallest hash itself is located:

1. rows are counted per (class, leading hash digits): a map-side combined aggregate over two narrow columns
   with at most 4,096 results per class, which tells class sizes and where each running count passes n;
2. only the rows with those leading digits, one in 4,096 of a class, are put in order to read off the hash.

The sample is then a filter ``(hash, key) <= cut`` on the full rows: a scan with a broadcast lookup that has
one row per class. With more than ``MAX_COUNTS`` results of step 1 the rows are counted by fewer digits, which
gives the same cuts from larger edges; with that many classes by a single digit, rows are ranked by a shuffle on
(class, leading digits) instead, which spreads any class over 4,096 windows.

Keys should be unique within a class; rows that share a key are kept or left together.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions.hashing import DEFAULT_SEED, seed_hash
from reviewloom.plans.bounded import bounded_rows

PREFIX_DIGITS = 3
MAX_COUNTS = 500_000

Cutoffs = Mapping[object, Sequence[int]]


class TooManyGroups(ValueError):
    """There are more groups than a lookup table should hold."""


def _keyed(df: DataFrame, group: str | None, key: str, seed: int, digits: int = PREFIX_DIGITS) -> DataFrame:
    group_col = F.lit(0) if group is None else F.col(group)
    return (
        df.select(group_col.alias("_g"), F.col(key).alias("_k"), seed_hash(seed, key).alias("_h"))
        .filter(F.col("_g").isNotNull() & F.col("_k").isNotNull())
        .withColumn("_p", F.substring("_h", 1, digits))
    )


def _group_type(df: DataFrame, group: str | None) -> T.DataType:
    return T.IntegerType() if group is None else df.schema[group].dataType


class HashCounts:
    """Rows per (group, leading hash digits) of a table, held on the driver."""

    def __init__(self, df: DataFrame, group: str | None, key: str, seed: int = DEFAULT_SEED):
        self.df, self.group, self.key, self.seed = df, group, key, seed
        for self.digits in range(PREFIX_DIGITS, 0, -1):
            counted = _keyed(df, group, key, seed, self.digits).groupBy("_g", "_p").agg(F.count(F.lit(1)).alias("_n"))
            rows = bounded_rows(counted, MAX_COUNTS)
            if rows is not None:
                break
        else:
            raise TooManyGroups(f"{group} has too many values")
        self.counts: dict[object, list[tuple[str, int]]] = {}
        for r in sorted(rows, key=lambda r: r["_p"]):
            self.counts.setdefault(r["_g"], []).append((r["_p"], r["_n"]))

    @property
    def sizes(self) -> dict:
        return {g: sum(n for _p, n in parts) for g, parts in self.counts.items()}

    def cuts(self, wanted: Cutoffs) -> dict[tuple[object, int], tuple[str, object]]:
        """(group, n) -> (hash, key) of the group's n-th row in hash order, for 0 < n <= group size."""
        places = []
        for g, ns in wanted.items():
            for n in sorted({int(n) for n in ns if n > 0}):
                before = 0
                for prefix, rows in self.counts.get(g, ()):
                    if n <= before + rows:
                        places.append((g, prefix, n, n - before))
                        break
                    before += rows
        if not places:
            return {}
        fields = [("_g", _group_type(self.df, self.group)), ("_p", T.StringType()), ("_want", T.LongType()), ("_r", T.LongType())]
        schema = T.StructType([T.StructField(name, kind) for name, kind in fields])
        lookup = self.df.sparkSession.createDataFrame(places, schema)
        upto = Window.partitionBy("_g", "_p").orderBy("_h", "_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        # Keys are counted first, so a key that repeats a billion times is one row of the window.
        edge = (
            _keyed(self.df, self.group, self.key, self.seed, self.digits)
            .join(F.broadcast(lookup.select("_g", "_p").distinct()), ["_g", "_p"], "left_semi")
            .groupBy("_g", "_p", "_h", "_k")
            .agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_last", F.sum("_n").over(upto))
        )
        hit = edge.join(F.broadcast(lookup), ["_g", "_p"]).filter(
            (F.col("_last") - F.col("_n") < F.col("_r")) & (F.col("_r") <= F.col("_last"))
        )
        found = hit.select("_g", "_want", "_h", "_k").limit(len(places)).collect()
        return {(r["_g"], r["_want"]): (r["_h"], r["_k"]) for r in found}


def hash_segments(
    df: DataFrame,
    group: str | None,
    key: str,
    cutoffs: Cutoffs | Callable[[dict], Cutoffs],
    seed: int = DEFAULT_SEED,
    name: str = "segment",
) -> DataFrame:
    """Number each row by how many of its group's ascending cut-offs lie before its hash rank.

    Segment 0 is ranks 1..c0, segment 1 is c0+1..c1 and so on. ``cutoffs`` is a dictionary per group or a
    function from group sizes to one. Rows of groups without an entry, and rows with a null key or group,
    are dropped.
    """
    counts = HashCounts(df, group, key, seed)
    wanted = cutoffs(counts.sizes) if callable(cutoffs) else cutoffs
    cuts = counts.cuts(wanted)
    cut_type = T.StructType([T.StructField("h", T.StringType()), T.StructField("k", df.schema[key].dataType)])
    schema = T.StructType(
        [
            T.StructField("_g", _group_type(df, group)),
            T.StructField("_base", T.IntegerType()),
            T.StructField("_cuts", T.ArrayType(cut_type)),
        ]
    )
    table = [
        (g, sum(1 for n in ns if n <= 0), [cuts[(g, int(n))] for n in ns if (g, int(n)) in cuts])
        for g, ns in wanted.items()
    ]
    lookup = df.sparkSession.createDataFrame(table, schema)
    here = F.struct(seed_hash(seed, key).alias("h"), F.col(key).alias("k"))
    passed = F.size(F.filter("_cuts", lambda c: c < here))
    rows = df.withColumn("_g", F.lit(0) if group is None else F.col(group)).filter(F.col(key).isNotNull())
    return rows.join(F.broadcast(lookup), "_g").withColumn(name, F.col("_base") + passed).drop("_g", "_base", "_cuts")


def rank_by_hash(df: DataFrame, group: str, key: str, seed: int = DEFAULT_SEED, name: str = "hash_rank") -> DataFrame:
    """Every row with its position (from 1) in its group's hash order and the group's size ``_n``.

    Rows shuffle once, on (group, leading hash digits). Rows that share a key share the first one's position, and
    rows without a key or group are left out, as when cuts are looked up.
    """
    counts = _keyed(df, group, key, seed).groupBy("_g", "_p").agg(F.count(F.lit(1)).alias("_rows"))
    upto = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = counts.select(
        "_g",
        "_p",
        (F.sum("_rows").over(upto) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(Window.partitionBy("_g")).alias("_n"),
    )
    within = Window.partitionBy("_g", "_p").orderBy("_h", key)
    return (
        df.filter(F.col(group).isNotNull() & F.col(key).isNotNull())
        .withColumn("_g", F.col(group))
        .withColumn("_h", seed_hash(seed, key))
        .withColumn("_p", F.substring("_h", 1, PREFIX_DIGITS))
        .join(starts, ["_g", "_p"])
        .withColumn(name, F.col("_before") + F.rank().over(within))
        .drop("_g", "_p", "_h", "_before")
    )


def _first_ranks(df: DataFrame, group: str, key: str, quota: Mapping | Column, seed: int) -> DataFrame:
    ranked = rank_by_hash(df, group, key, seed, "_rank")
    if isinstance(quota, Mapping):
        schema = T.StructType([T.StructField(group, df.schema[group].dataType), T.StructField("_quota", T.LongType())])
        table = df.sparkSession.createDataFrame([(g, int(n)) for g, n in quota.items()], schema)
        ranked = ranked.join(F.broadcast(table) if len(quota) <= MAX_COUNTS else table, group)
        quota = F.col("_quota")
    else:
        smallest = df.filter(F.col(group).isNotNull() & F.col(key).isNotNull()).groupBy(group).count().agg(F.min("count"))
        ranked = ranked.withColumn("_min", smallest.scalar())
    return ranked.filter(F.col("_rank") <= quota).select(*df.columns)


def take_by_hash(
    df: DataFrame,
    group: str | None,
    key: str,
    quota: Mapping[object, int] | int | Callable[[dict], Mapping[object, int]],
    seed: int = DEFAULT_SEED,
    many_groups_quota: Column | None = None,
) -> DataFrame:
    """The first ``quota`` rows of each group in hash order.

    ``quota`` is a dictionary per group, a function from group sizes to one, or a number when there are no
    groups. For a function, ``many_groups_quota`` says the same as an expression over ``_n`` (rows in the
    group) and ``_min`` (rows in the smallest group); it serves when there are too many groups to look up.
    """
    if group is None:
        cutoffs: Cutoffs | Callable = {0: [int(quota)]}
    elif callable(quota):
        cutoffs = lambda sizes: {g: [n] for g, n in quota(sizes).items()}
    else:
        cutoffs = {g: [n] for g, n in quota.items()}
    try:
        return hash_segments(df, group, key, cutoffs, seed, "_seg").filter("_seg = 0").select(*df.columns)
    except TooManyGroups:
        return _first_ranks(df, group, key, many_groups_quota if callable(quota) else quota, seed)
