"""Mixing sources to target weights: exact quotas of blocks, split among output shards by a hypergeometric tree."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from reviewloom.llm.base import n_words, query, table
from reviewloom.plans.session import cut_lineage

#: Hash digits of one level of the search for a cut, and rows of the last block, which is filled row by row.
LEVEL_BITS, LAST_ROWS = 12, 64
#: Texts longer than this part of their source are chosen first and by themselves; a source has fewer than 1 / LONG.
LONG = 1 / 256
#: Part of what a source has yet to take by which its long texts may miss before other choices of them are tried.
NEAR = 0.001


def water_fill(sizes: Sequence[int], weights: Sequence[float], share: float, most: float) -> list[float]:
    """Targets in proportion to the weights that sum to ``share`` of all sizes, none above ``most`` times its size.

    What a source can't take is shared among the others by weight, until none is above.
    """
    left, out = share * sum(sizes), [0.0] * len(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    while open_:
        level = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if most * sizes[i] <= level * weights[i]]
        if not full:
            for i in open_:
                out[i] = level * weights[i]
            break
        for i in full:
            out[i] = float(most * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def split_quotas(blocks: Sequence[int], n_shards: int, rng: np.random.Generator) -> np.ndarray:
    """Matrix (shard, source) of block counts: each source's blocks are dealt out exactly.

    A node of the tree halves its shards and draws, from the blocks it has of each source, the left half's part
    from a multivariate hypergeometric distribution.
    """
    out = np.zeros((n_shards, len(blocks)), np.int64)
    todo = [(0, n_shards, np.asarray(blocks, np.int64))]
    while todo:
        a, b, have = todo.pop()
        if b - a == 1:
            out[a] = have
            continue
        mid = (a + b) // 2
        left = rng.multivariate_hypergeometric(have, int(have.sum()) * (mid - a) // (b - a), method="marginals")
        todo += [(a, mid, left), (mid, b, have - left)]
    return out


def _digits(h: Column, skip: Column, bits: Column) -> Column:
    """``bits`` bits of a 64-bit hash behind the first ``skip``."""
    shifted = F.call_function("shiftrightunsigned", F.call_function("shiftleft", h, skip.cast("int")), (F.lit(64) - bits).cast("int"))
    return F.when(bits > 0, shifted).otherwise(F.lit(0).cast("bigint"))


def _fill(pdf: pd.DataFrame) -> pd.DataFrame:
    """Rows of a source's last block in hash order, each taken if it still fits; of what is left, the nearest."""
    pdf = pdf.sort_values(["h", "size"], ignore_index=True)
    left, taken = float(pdf["rest"].iloc[0]), []
    for k, size in enumerate(pdf["size"]):
        if size <= left:
            taken.append(k)
            left -= size
    others = pdf.index.difference(taken)
    if len(others) and pdf.loc[others, "size"].min() < 2 * left:
        taken.append(pdf.loc[others, "size"].idxmin())
    return pdf.loc[taken, ["source_no", "h"]]


def choose_long(sizes: Sequence[int], rest: float, short: float) -> list[int]:
    """Which of a source's long texts, in hash order, are taken, so that its short ones can make up the ``rest``.

    They get their share of the rest, each in turn if it still fits. If the ``short`` words can't fill what is left,
    or it is overdrawn, every length passed over is tried as the first, and the longest first; the nearest is taken.
    """
    low = max(0.0, rest - short)
    miss = lambda taken: max(low - (n := sum(sizes[k] for k in taken)), n - rest, 0.0)

    def greedy(order: Sequence[int], aim: float, first: Sequence[int] = ()) -> list[int]:
        taken = list(first)
        left = aim - sum(sizes[k] for k in taken)
        for k in order:
            if sizes[k] <= left and k not in first:
                taken.append(k)
                left -= sizes[k]
        others = set(order).difference(taken)
        if not others:
            return taken
        nearest = [*taken, min(others, key=lambda k: (sizes[k], k))]
        return nearest if (miss(nearest), abs(left - sizes[nearest[-1]])) < (miss(taken), abs(left)) else taken

    order = range(len(sizes))
    best = greedy(order, rest * sum(sizes) / max(1, sum(sizes) + short))
    if miss(best) > NEAR * rest:
        firsts = {sizes[k]: (k,) for k in reversed(order) if k not in best}
        tries = [greedy(order, rest, f) for f in [(), *firsts.values()]]
        best = min([best, *tries, greedy(sorted(order, key=lambda k: -sizes[k]), rest)], key=miss)
    return best


def _long_texts(coded: DataFrame, parts: list[dict]) -> DataFrame:
    """(source_no, h, chosen) of the long texts, chosen 1 or 0; takes them out of each source's size, rows and rest."""
    spark = coded.sparkSession
    state = spark.createDataFrame(
        [(p["no"], p["size"], float(p["target"] - p["size"] * p["passes"])) for p in parts], "source_no int, source_size bigint, rest double"
    )
    groups = coded.groupBy("source_no", "h").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    longs = cut_lineage(groups.join(F.broadcast(state), "source_no").where(F.col("size") > F.col("source_size") * LONG), "mix-long")

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("h", ignore_index=True)
        taken = choose_long(pdf["size"].tolist(), pdf["rest"].iloc[0], float(pdf["source_size"].iloc[0] - pdf["size"].sum()))
        return pdf.assign(chosen=pdf.index.isin(taken).astype("int32"))[["source_no", "h", "chosen", "size", "rows"]]

    chosen = cut_lineage(longs.groupBy("source_no").applyInPandas(choose, "source_no int, h bigint, chosen int, size bigint, rows bigint"), "mix-long")
    sums = chosen.groupBy("source_no").agg(F.sum("size").alias("size"), F.sum("rows").alias("rows"), F.sum(F.col("size") * F.col("chosen")).alias("taken"))
    found = {r.source_no: r for r in sums.collect()}
    for p in parts:
        r = found.get(p["no"])
        p["rest"] = p["target"] - p["size"] * p["passes"] - (r.taken if r else 0)
        p["short_rows"] = p["rows"] - (r.rows if r else 0)
        p["short_size"] = p["size"] - (r.size if r else 0)
    return chosen.select("source_no", "h", "chosen")


def plan_sources(sized: DataFrame, weights: Sequence[float], share: float, most: float, max_sources: int) -> list[dict]:
    """One entry per source in code point order, null last, with its size, weight and target."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError(f"more than {max_sources} sources; raise max_sources if the driver can hold a row for each")
    rows.sort(key=lambda r: (r.source is None, r.source or ""))
    targets = water_fill([r.size for r in rows], [weights[i % len(weights)] for i in range(len(rows))], share, most)
    return [{"source": r.source, "no": i, "size": r.size, "rows": r.rows, "target": t} for i, (r, t) in enumerate(zip(rows, targets, strict=True))]


def _find_cuts(sized: DataFrame, parts: list[dict]) -> list[dict]:
    """Narrow each source's cut to one small block of hash values; fills in skip, bits, prefix and rest.

    A level counts the sizes of up to 2**LEVEL_BITS blocks per source and descends into the block where the sum
    passes the rest. Levels follow until no cut block has more than LAST_ROWS * 4 rows, whatever a source holds.
    """
    spark = sized.sparkSession
    for p in parts:
        p |= {"skip": 0, "prefix": 0, "bits": int(np.clip(np.log2(max(1, p["short_rows"] / LAST_ROWS)), 0, LEVEL_BITS))}
    todo = [p for p in parts if p["rest"] > 0 and p["short_size"] > 0]
    while todo:
        state = spark.createDataFrame(
            [(p["no"], p["skip"], p["bits"], p["prefix"], float(p["rest"])) for p in todo], "source_no int, skip int, bits int, prefix bigint, rest double"
        )
        near = sized.join(F.broadcast(state), "source_no").where(_digits(F.col("h"), F.lit(0), F.col("skip")) == F.col("prefix"))
        block = near.withColumn("block", _digits(F.col("h"), F.col("skip"), F.col("bits")))
        sums = block.groupBy("source_no", "rest", "block").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
        upto = F.sum("size").over(Window.partitionBy("source_no").orderBy("block"))
        cut = sums.withColumn("upto", upto).where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("size") <= F.col("rest")))
        found = {r.source_no: r for r in cut.groupBy("source_no").agg(F.min_by(F.struct("block", "rows", "upto", "size"), "block").alias("b")).select("source_no", "b.*").collect()}
        later = []
        for p in todo:
            r: Row | None = found.get(p["no"])
            if r is None:  # the rest takes the whole source
                p |= {"done": True}
                continue
            p |= {"prefix": p["prefix"] << p["bits"] | r.block, "skip": p["skip"] + p["bits"], "rest": p["rest"] - (r.upto - r.size)}
            p["bits"] = int(np.clip(np.log2(max(1, r.rows / LAST_ROWS)), 0, min(LEVEL_BITS, 48 - p["skip"])))
            if r.rows > 4 * LAST_ROWS and p["bits"] > 0:
                later.append(p)
        todo = later
    return parts


@dataclass
class Plan:
    """Small tables that turn (source, size, h) of a row into its copies and their shards."""

    numbers: DataFrame
    state: DataFrame
    chosen: DataFrame
    homes: DataFrame
    n_blocks: int
    seed: int

    def apply(self, rows: DataFrame) -> DataFrame:
        """Add source_size, target, copies and shards; nothing but the plan's tables is sent around."""
        source = rows["source"]
        coded = rows.join(F.broadcast(self.numbers), source.eqNullSafe(self.numbers["source"])).drop(self.numbers["source"])
        joined = coded.join(F.broadcast(self.state), "source_no").join(F.broadcast(self.chosen), ["source_no", "h"], "left")
        digits = _digits(F.col("h"), F.lit(0), F.col("skip"))
        more = F.coalesce(F.col("chosen"), (F.col("whole") | (digits < F.col("prefix"))).cast("int"), F.lit(0))
        copies = F.when(F.col("size") > 0, F.col("passes") + F.when(F.col("skip").isNotNull(), more).otherwise(0)).otherwise(0)
        block = lambda t: F.pmod(F.xxhash64(F.lit(self.seed), t["turn"], F.col("h")), F.lit(self.n_blocks)).cast("int")
        out = joined.withColumn("copies", copies).join(F.broadcast(self.homes), "source_no")
        shards = F.transform(F.slice("turns", F.lit(1), F.col("copies")), lambda t: F.element_at(t["homes"], block(t) + 1))
        return out.withColumn("shards", shards).drop("source_no", "passes", "skip", "prefix", "rest", "whole", "chosen", "turns")


def plan_mix(
    sized: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: int = 17, n_shards: int = 8,
    blocks_per_shard: int = 16, max_sources: int = 100_000,
) -> Plan:
    """Work out targets, cuts and block places for a table of (source, size, h); see :func:`mix_sources`."""
    spark = sized.sparkSession
    parts = plan_sources(sized, weights, share, most, max_sources)
    for p in parts:
        p["passes"] = min(most, int(p["target"] // p["size"])) if p["size"] else 0
    numbers = spark.createDataFrame([(p["source"], p["no"]) for p in parts], f"source {sized.schema['source'].dataType.simpleString()}, source_no int")
    coded = sized.join(F.broadcast(numbers), sized["source"].eqNullSafe(numbers["source"])).select("size", "h", "source_no").where("size > 0")
    partial = [p for p in parts if p["size"] and p["target"] > p["passes"] * p["size"]]
    longs = _long_texts(coded, partial)
    short = coded.join(longs, ["source_no", "h"], "left_anti")
    _find_cuts(short, partial)
    fields = "source_no int, source_size bigint, target double, passes int, skip int, prefix bigint, rest double, whole boolean"
    state = spark.createDataFrame(
        [(p["no"], p["size"], p["target"], p["passes"], p.get("skip"), p.get("prefix"), p.get("rest"), p.get("done", False)) for p in parts], fields
    )
    last = short.join(F.broadcast(state), "source_no").where(F.col("skip").isNotNull() & ~F.col("whole") & (F.col("rest") > 0))
    last = last.where(_digits(F.col("h"), F.lit(0), F.col("skip")) == F.col("prefix"))
    per_hash = last.groupBy("source_no", "h").agg(F.sum("size").alias("size"), F.first("rest").alias("rest"))
    chosen = per_hash.groupBy("source_no").applyInPandas(_fill, "source_no int, h bigint").withColumn("chosen", F.lit(1)).unionByName(longs)

    n_blocks, rng = n_shards * blocks_per_shard, np.random.default_rng(seed)
    places = []
    for turn in range(most):
        quotas = split_quotas([n_blocks] * len(parts), n_shards, rng)
        for i, p in enumerate(parts):
            homes = np.repeat(np.arange(n_shards), quotas[:, i])[rng.permutation(n_blocks)]
            places.append((p["no"], turn, homes.tolist()))
    wide = spark.createDataFrame(places, "source_no int, turn int, homes array<int>").groupBy("source_no").agg(
        F.sort_array(F.collect_list(F.struct("turn", "homes"))).alias("turns")
    )
    return Plan(numbers, state, cut_lineage(chosen, "mix-chosen"), wide, n_blocks, seed)


def _hash(id_col: str, text_col: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.col(text_col)))


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, **options
) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken, shards) of every row of ``docs``.

    Sources in code point order weigh ``weights``, repeating, and share ``share`` of all sizes; a target stops at
    ``most`` times its source's size, and the excess goes to the others. A target over its source's size gives
    whole passes, which take every row, and a part of one more. Of that part, texts longer than ``LONG`` of their
    source are chosen first, so that the others can make up what is left; these are a prefix in hash order, found
    by counting blocks of hash values, and in the last block rows are taken while they fit. So the sum comes within
    half of ``LONG`` of the source's size of the target, unless its long texts are most of it and no choice tried
    by :func:`choose_long` comes near. Each pass is cut into blocks by a permutation of its own, and ``split_quotas`` deals these
    out among ``n_shards`` shards, exactly ``blocks_per_shard`` times the sources to each; ``shards`` names the
    shard of each copy. Only sizes, hashes and counts are shuffled, and all of it repeats with the same seed.

    Size is the number of words; a null or empty text has none, and such rows are never taken. Rows without a
    source are a source of their own, last. Rows that share an id are drawn together, as are rows without an id
    that share a text. Texts are counted whole; other columns are not read; an empty table gives no rows. The
    driver holds one row per source, which is checked against ``max_sources``, and its block places.
    """
    sized = cut_lineage(
        docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(text_col).alias("size"), _hash(id_col, text_col, seed).alias("h")),
        "mix-sizes",
    )
    out = plan_mix(sized, seed=seed, **options).apply(sized)
    taken = (F.col("copies") * F.col("size")).cast("bigint")
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "copies", taken.alias("taken"), "shards")


def draw(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, **options) -> DataFrame:
    """The rows of ``docs`` that :func:`mix_sources` takes, each as often as it is taken, with their columns as they were.

    The plan is made from a table without texts; the rows themselves meet it where they lie and don't move.
    """
    rows = docs.select(
        F.struct("*").alias("row"), F.col(source_col).alias("source"), n_words(text_col).alias("size"), _hash(id_col, text_col, seed).alias("h")
    )
    sized = cut_lineage(rows.select("source", "size", "h"), "mix-sizes")
    taken = plan_mix(sized, seed=seed, **options).apply(rows).where("copies > 0")
    return taken.withColumn("copy", F.explode("shards")).select("row.*")


@query("op4_mix_sources")
def op4_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    out = mix_sources(table(spark, folder, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies", "shards")
