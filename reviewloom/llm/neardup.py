"""Near-duplicate documents: an LSH forest proposes groups, full shingle sets confirm every link."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from reviewloom.llm.base import WORD, free_name, query, shingles, slices, table
from reviewloom.llm.graph import components
from reviewloom.plans.bounded import fits_broadcast, lookup_join
from reviewloom.plans.session import cut_lineage

#: Trees of the forest, hash values per tree, and the shortest common prefix that makes two documents neighbours.
TREES, DEPTH, LEAST_PREFIX = 16, 8, 3
#: Most members of a region that the task which reads it compares; a larger one is dealt out in blocks.
REGION = 2048
#: Most members, and shingles, that one verifying task holds at once.
BLOCK, BLOCK_SHINGLES = 1024, 4_000_000
#: Members of a block's largest component that visit the first blocks of their group, and how many blocks those are.
DELEGATES, HUBS = 64, 2

#: Copies of one set from which its rows meet their component by a lookup.
HOT_COPIES = 256

_RNG = np.random.default_rng(97)
_XOR = _RNG.integers(0, 2**63, TREES * DEPTH, dtype=np.uint64)
_ODD = _RNG.integers(0, 2**63, TREES * DEPTH, dtype=np.uint64) | np.uint64(1)


def signature(hashes: np.ndarray) -> np.ndarray:
    """MinHash values (32 bits each) of a set of 64-bit hashes."""
    out = np.full(TREES * DEPTH, 2**32 - 1, np.uint32)
    with np.errstate(over="ignore"):
        for a in range(0, len(hashes), 4096):
            part = ((hashes[a : a + 4096, None] ^ _XOR) * _ODD >> np.uint64(32)).min(axis=0)
            out = np.minimum(out, part.astype(np.uint32))
    return out


def sketch(sig: np.ndarray) -> bytes:
    """Four bits of each value, two values to a byte."""
    low = (sig & 15).astype(np.uint8)
    return (low[0::2] | low[1::2] << 4).tobytes()


def agreements(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """How many values two sketches share, for all pairs of rows given as eight 64-bit words each."""
    ones = np.uint64(0x1111111111111111)
    differ = np.zeros((len(rows), len(others)), np.uint16)
    for k in range(rows.shape[1]):
        x = rows[:, k, None] ^ others[None, :, k]
        x |= x >> np.uint64(1)
        x |= x >> np.uint64(2)
        differ += np.bitwise_count(x & ones)
    return TREES * DEPTH - differ


def least_agreement(similarity: float) -> int:
    """Shared values that a pair at the similarity falls short of with a chance of about one in 100,000."""
    p = similarity + (1 - similarity) / 16
    n = TREES * DEPTH
    return int(n * p - 4.3 * np.sqrt(n * p * (1 - p)))


def local_roots(adjacent: np.ndarray) -> np.ndarray:
    """Smallest member of each member's component in a symmetric matrix."""
    label = np.arange(len(adjacent))
    while True:
        found = np.where(adjacent, label[None, :], label[:, None]).min(axis=1, initial=len(label))
        found = np.minimum(found, label)
        found = found[found]
        if (found == label).all():
            return label
        label = found


def shingle_table(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, key, n_shingles, sig) per row; equal sets share a 128-bit key, an empty set has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            keys, sizes, sigs = [], [], []
            for text in batch.column("text").to_pylist():
                own = shingles(text, words)
                sizes.append(len(own))
                keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                sigs.append(signature(own).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary())], names=["id", "key", "n_shingles", "sig"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, key binary, n_shingles long, sig binary")


def forest(nodes: DataFrame) -> DataFrame:
    """One row per node and tree: the tree's prefix in three numbers, the key and the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sigs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, TREES, DEPTH).astype(np.int64)
            sketches = pa.array([sketch(s.reshape(-1).astype(np.uint32)) for s in sigs], pa.binary())
            for t in range(TREES):
                v = sigs[:, t]
                numbers = [pa.array((v[:, a] << 32 | v[:, a + 1]).view(np.int64)) for a in (0, 2, 4)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(v), t, np.int32)), *numbers, batch.column("key"), sketches], names=["tree", "p1", "p2", "p3", "key", "sketch"]
                )

    return nodes.select("key", "sig").mapInArrow(run, "tree int, p1 long, p2 long, p3 long, key binary, sketch binary")


def _regions(prefix: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of more than one sorted row with an equal prefix of LEAST_PREFIX values."""
    own = prefix[:, :LEAST_PREFIX]
    cuts = np.flatnonzero((own[1:] != own[:-1]).any(axis=1)) + 1
    edges = np.concatenate(([0], cuts, [len(own)]))
    for k in np.flatnonzero(np.diff(edges) > 1).tolist():
        yield int(edges[k]), int(edges[k + 1])


def _agree(own: np.ndarray, others: np.ndarray, least: int) -> np.ndarray:
    return np.concatenate([agreements(own[x : x + 256], others) >= least for x in range(0, len(own), 256)])


def proposed_links(trees: DataFrame, least: int) -> DataFrame:
    """(a, b): links that tie together all members of a region whose sketches agree.

    The sorted orders are dealt by range, so a prefix that very many nodes share is spread over tasks, and a
    task reads its sorted rows as a stream. It compares the regions that it holds whole, up to REGION members.
    A larger region, and one that may go on in the next task, is gathered by its prefix and compared in blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        loose = None  # the region whose rows go out to be compared in blocks
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = [np.asarray(batch.column(c), np.int64) for c in ("p1", "p2")]
            tree = np.asarray(batch.column("tree"), np.int64) << 32
            short = np.stack([tree | numbers[0] >> 32 & 0xFFFFFFFF, numbers[0] & 0xFFFFFFFF, numbers[1] >> 32], axis=1)
            keys = np.array([*batch.column("key").to_pylist(), None], object)[:-1]
            words = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint64).reshape(-1, 8)
            if loose is None:  # the first region may have begun in the task before
                loose = short[0]
            if held is not None:
                short, keys, words = (np.concatenate(x) for x in zip(held, (short, keys, words), strict=True))
            cuts = np.flatnonzero((short[1:] != short[:-1]).any(axis=1)) + 1
            starts = np.concatenate(([0], cuts))
            sizes = np.diff(np.concatenate((starts, [len(short)])))
            out = sizes > REGION
            out[0] |= (short[0] == loose).all()
            if out[-1]:
                loose = short[-1]
            rows = np.repeat(out, sizes)
            held = None
            inside = ~rows
            if not out[-1]:
                inside[starts[-1] :] = False
                held = (short[starts[-1] :], keys[starts[-1] :], words[starts[-1] :])
            pairs: set = set()
            own, own_keys = words[inside], keys[inside]
            for a, b in _regions(short[inside]):
                roots = local_roots(_agree(own[a:b], own[a:b], least))
                for x in np.flatnonzero(roots != np.arange(b - a)).tolist():
                    pairs.add((own_keys[a + roots[x]], own_keys[a + x]))
            yield proposals(pairs, short[rows], keys[rows], words[rows])
        if held is not None:  # the last region may go on in the next task
            yield proposals(set(), *held)

    def proposals(pairs: set, short: np.ndarray, keys: np.ndarray, words: np.ndarray) -> pa.RecordBatch:
        n, m = len(pairs), len(keys)
        columns = [
            [p[0] for p in pairs] + [None] * m, [p[1] for p in pairs] + keys.tolist(),
            [None] * n + [r.tobytes() for r in short], [None] * n + [w.tobytes() for w in words],
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["a", "b", "cluster", "sketch"])

    order = ["tree", "p1", "p2", "p3", "key"]
    dealt = trees.repartitionByRange(*order).sortWithinPartitions(*order)
    found = cut_lineage(dealt.mapInArrow(run, "a binary, b binary, cluster binary, sketch binary"), "proposed")
    links = found.where("cluster is null").select("a", "b")
    gathered = found.where("cluster is not null").select("cluster", F.col("b").alias("key"), F.col("sketch").alias("hashes"))
    sizes = gathered.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = cut_lineage(sizes.select("cluster", F.ceil(F.col("n") / BLOCK).cast("int").alias("n_blocks")), "regions")
    block = F.pmod(F.xxhash64("key"), F.col("n_blocks")).cast("int")
    members = lookup_join(gathered, sizes, "cluster", spread_by=("key",)).select("cluster", "n_blocks", block.alias("block"), "key", "hashes")

    def linked(a: list[bytes], b: list[bytes]) -> np.ndarray:
        own, others = (np.frombuffer(b"".join(x), np.uint64).reshape(-1, 8) for x in (a, b))
        return _agree(own, others, least)

    return links.unionByName(group_links(cut_lineage(members, "regions"), linked))


def shared_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections between two lists of sorted hash arrays, by products of 0/1 matrices."""
    if len(a) * len(b) <= 16:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in b] for x in a], np.int64).reshape(len(a), len(b))
    flat = [np.concatenate(x) for x in (a, b)]
    owner = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (a, b)]
    both = np.intersect1d(np.unique(flat[0]), np.unique(flat[1]), assume_unique=True)
    if a is b:
        values, counts = np.unique(flat[0], return_counts=True)
        both = values[counts > 1]
    out = np.zeros((len(a), len(b)), np.int64)
    at = [np.searchsorted(both, f) for f in flat]
    hit = [np.flatnonzero((i < len(both)) & (both[np.minimum(i, len(both) - 1)] == f)) if len(both) else np.zeros(0, int) for i, f in zip(at, flat, strict=True)]
    for low in range(0, len(both), 4096):
        width = min(4096, len(both) - low)
        m = []
        for n, i, h, o in zip((len(a), len(b)), at, hit, owner, strict=True):
            use = h[(i[h] >= low) & (i[h] < low + width)]
            part = np.zeros((n, width), np.float32)
            part[o[use], i[use] - low] = 1
            m.append(part)
        out += np.rint(m[0] @ m[1].T).astype(np.int64)
    if a is b:
        np.fill_diagonal(out, [len(s) for s in a])
    return out


def _linked(a: list[np.ndarray], b: list[np.ndarray], percent: int) -> np.ndarray:
    common = shared_counts(a, b)
    union = np.array([len(s) for s in a])[:, None] + np.array([len(s) for s in b])[None, :] - common
    return 100 * common >= percent * union


def confirmed_links(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that hold on full sets."""

    def linked(a: list[bytes], b: list[bytes]) -> np.ndarray:
        own = [np.frombuffer(x, np.uint64) for x in a]
        return _linked(own, own if b is a else [np.frombuffer(x, np.uint64) for x in b], percent)

    return group_links(members, linked)


def group_links(members: DataFrame, linked: Callable[[list[bytes], list[bytes]], np.ndarray]) -> DataFrame:
    """(a, b): links between members of a group, each member tied to the first of its local component.

    ``members`` has (cluster, n_blocks, block, key, hashes), and ``linked`` compares two lists of hashes; a key may
    be in several groups. A group that fits one block is compared
    within one task, all pairs by matrix products. Of a larger group every block is compared within. Then what a
    block did not join to its largest component, and some delegates of that, visit the group's first blocks. What
    is still outside the group's largest component visits all blocks: a link that is missing by then has an end there.
    """

    def within(part: pa.Table) -> pa.Table:
        part = part.sort_by("key")
        keys, sets = part["key"].to_pylist(), part["hashes"].to_pylist()
        roots = local_roots(linked(sets, sets))
        names, counts = np.unique(roots, return_counts=True)
        inner = np.flatnonzero(roots == names[np.argmax(counts)])
        visits = np.ones(len(keys), bool)
        visits[inner[DELEGATES:]] = False
        return pa.table(
            {"cluster": part["cluster"], "n_blocks": part["n_blocks"], "block": part["block"], "b": part["key"],
             "a": pa.array([keys[r] for r in roots], pa.binary()), "visits": pa.array(visits)}
        )

    schema = "cluster binary, n_blocks int, block int, b binary, a binary, visits boolean"
    inner = cut_lineage(members.groupBy("cluster", "block").applyInArrow(within, schema), "links")
    links = inner.where("a <> b").select("a", "b")
    if inner.where("n_blocks > 1").isEmpty():
        return links

    def across(part: pa.Table) -> pa.Table:
        home = np.asarray(part["home"])
        keys, sets = part["key"].to_pylist(), part["hashes"].to_pylist()
        mine, guests = np.flatnonzero(home), np.flatnonzero(~home)
        roots = part["root"].to_pylist()
        mine = np.array(sorted(mine.tolist(), key=lambda i: roots[i]), int)
        first = [y for y, i in enumerate(mine) if not y or roots[i] != roots[mine[y - 1]]]
        hits = linked([sets[i] for i in guests], [sets[i] for i in mine]) if len(mine) and len(guests) else np.zeros((0, 0), bool)
        hits = np.logical_or.reduceat(hits, first, axis=1) if hits.size else hits
        found = [(keys[guests[x]], roots[mine[first[y]]]) for x, y in np.argwhere(hits).tolist()]
        return pa.table({c: pa.array([p[k] for p in found], pa.binary()) for k, c in enumerate(("a", "b"))})

    wide = members.where("n_blocks > 1").join(inner.select("cluster", F.col("b").alias("key"), F.col("a").alias("root"), "visits"), ["cluster", "key"])

    def met(visitors: DataFrame, hubs: int | None) -> DataFrame:
        """Links of the visitors with other blocks of their group, the first ``hubs`` or all; in parties of a bounded size."""
        load = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum(F.octet_length("hashes")) / 8 / BLOCK_SHINGLES)
        parties = cut_lineage(visitors.groupBy("cluster").agg(F.ceil(load).cast("int").alias("parties")), "parties")
        last = F.col("n_blocks") if hubs is None else F.least(F.col("n_blocks"), F.lit(hubs))
        hosts = lookup_join(wide.where(F.col("block") < last), parties, "cluster", spread_by=("key",))
        home = hosts.withColumn("party", F.explode(F.sequence(F.lit(0), F.col("parties") - 1)))
        others = F.filter(F.sequence(F.lit(0), last - 1), lambda x: x != F.col("block"))
        own = F.pmod(F.xxhash64("key"), F.col("parties")).cast("int").alias("party")
        guests = lookup_join(visitors, parties, "cluster", spread_by=("key",))
        guests = guests.select("cluster", F.explode(others).alias("block"), own, "key", "hashes", "root", F.lit(False).alias("home"))
        both = home.select("cluster", "block", "party", "key", "hashes", "root", F.lit(True).alias("home")).unionByName(guests)
        return cut_lineage(both.groupBy("cluster", "block", "party").applyInArrow(across, "a binary, b binary"), "links")

    first = met(wide.where("visits"), HUBS)
    labels = components(inner.where("n_blocks > 1 and a <> b").select("a", "b").unionByName(first))
    rooted = inner.where("n_blocks > 1").select("cluster", F.col("b").alias("node")).join(labels, "node", "left")
    rooted = rooted.select("cluster", "node", F.coalesce("root", "node").alias("root"))
    sizes = rooted.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("cluster").agg(F.max_by("root", F.struct("n", "root")).alias("largest"))
    outside = lookup_join(rooted, largest, "cluster", spread_by=("node",)).where("root <> largest").select("cluster", F.col("node").alias("key"))
    outside = cut_lineage(outside, "outside")
    if outside.isEmpty():
        return links.unionByName(first)
    return links.unionByName(first).unionByName(met(wide.join(outside, ["cluster", "key"], "left_semi"), None))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80,
) -> DataFrame:
    """(id, n_shingles, component_id, kept, set_key) of every row: documents linked at ``percent`` similarity or more.

    Texts are lower-cased in A-Z and cut into words at ASCII white space; a document's set holds its distinct
    shingles of ``words`` words, or its whole sequence if that is shorter. Documents with one and the same set
    are one node. Each tree of the forest sorts the nodes by its own MinHash values. Regions of a common prefix
    of three values, of any size, propose groups by sketch; groups are confirmed on full sets. A pair at the
    threshold is missed with a chance of about 1 in 20,000 where no other link joins it, and less above. Regions
    of more than REGION nodes are compared in blocks, whose work grows with the square of a region if most of its
    nodes are unlinked.

    ``component_id`` is the smallest id reachable over links; ``kept`` marks the row that has it, so of rows
    repeated under one id all are marked. Null and empty texts and texts without words have no set and stay
    alone; rows with a null id are smaller than none (they are kept only if their whole component has no id).
    Long texts count whole; other columns are not read; an empty table gives no rows.
    """
    spread = cut_lineage(shingle_table(docs, id_col, text_col, words), "shingles")
    slim = spread.select("id", "key", "n_shingles")
    nodes = spread.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("id").alias("id"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.count(F.lit(1)).alias("copies")
    )
    nodes = cut_lineage(nodes, "nodes")
    groups = components(proposed_links(forest(nodes), least_agreement(percent / 100)))
    joined = groups.withColumnRenamed("node", "key").join(nodes.drop("sig", "copies"), "key")
    sizes = joined.groupBy("root").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"))
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    wanted = joined.join(sizes.select("root", blocks.alias("n_blocks")), "root")
    wanted = wanted.select(
        F.col("root").alias("cluster"), "n_blocks", F.pmod(F.xxhash64("key"), F.col("n_blocks")).cast("int").alias("block"), "key", F.col("id").alias("wanted_id")
    )
    members = cut_lineage(_with_sets(docs, wanted, id_col, text_col, words), "members")
    linked = components(confirmed_links(members, percent))
    smallest = linked.withColumnRenamed("node", "key").join(nodes.select("key", "id"), "key")
    smallest = smallest.groupBy("root").agg(F.min("id").alias("component"))
    found = linked.join(smallest, "root").select(F.col("node").alias("key"), "component")
    named = nodes.select("key", "id", "copies").join(found, "key", "left").select("key", "copies", F.coalesce("component", "id").alias("component_id"))
    out = _rows_of_nodes(slim, cut_lineage(named, "named"))
    return out.select(
        F.col("id").alias(id_col), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), F.col("key").alias("set_key")
    )


def _rows_of_nodes(slim: DataFrame, named: DataFrame) -> DataFrame:
    """Every row with its node's component. Rows without a set are their own, and those of nodes with many copies
    meet a lookup, so neither lands in one task of the join by key."""
    alone = slim.where(F.col("key").isNull()).withColumn("component_id", F.col("id"))
    hot = named.where(F.col("copies") > HOT_COPIES).select("key", F.col("component_id").alias("hot"), F.lit(True).alias("is_hot"))
    tagged = lookup_join(slim.where(F.col("key").isNotNull()), hot, "key", "left", spread_by=("id",))
    many = tagged.where("is_hot").select("id", "key", "n_shingles", F.col("hot").alias("component_id"))
    few = tagged.where("is_hot is null").join(named.where(F.col("copies") <= HOT_COPIES), "key").select("id", "key", "n_shingles", "component_id")
    return alone.select("id", "key", "n_shingles", "component_id").unionByName(many).unionByName(few)


def _with_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """The members of proposed groups with their hash sets, one row per key, taken from the texts once more."""
    wanted = cut_lineage(wanted, "wanted")
    texts = docs.select(F.col(id_col).alias("own_id"), F.col(text_col).alias("text"))
    side = F.broadcast(wanted) if fits_broadcast(wanted, max_rows=200_000, max_bytes=16 << 20) else wanted
    hits = texts.join(side, texts["own_id"].eqNullSafe(side["wanted_id"])).select("cluster", "n_blocks", "block", "key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [shingles(t, words).tobytes() for t in batch.column("text").to_pylist()]
            same = pa.array([hashlib.blake2b(s, digest_size=16).digest() == k for s, k in zip(sets, batch.column("key").to_pylist(), strict=True)])
            columns = [*(batch.column(c) for c in ("cluster", "n_blocks", "block", "key")), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n_blocks", "block", "key", "hashes"]).filter(same)

    found = hits.mapInArrow(run, "cluster binary, n_blocks int, block int, key binary, hashes binary")
    return found.dropDuplicates(["key"])


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns as they were.

    Where ids are unique, only the ids of dropped rows meet the table, broadcast if measured small. Where an id
    occurs again, rows are matched by id and shingle set, and of rows that agree in both one stays.
    """
    found = cut_lineage(near_duplicates(docs, id_col, text_col, words, percent), "near-duplicates")
    own, theirs = free_name(docs.columns, "set_key"), free_name(docs.columns, "other_id")
    if found.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        gone = found.where(~F.col("kept")).select(F.col(id_col).alias(theirs))
        gone = F.broadcast(gone) if fits_broadcast(gone) else gone
        return docs.join(gone, docs[id_col].eqNullSafe(gone[theirs]), "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            sets = [shingles(t, words) for t in batch.column(text_col).to_pylist()]
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names=[*batch.schema.names, own])

    keyed = docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(own, BinaryType())]))
    kept = found.where("kept").select(F.col(id_col).alias(theirs), F.col("set_key").alias(f"{theirs}_key")).distinct()
    same = keyed[id_col].eqNullSafe(kept[theirs]) & keyed[own].eqNullSafe(kept[f"{theirs}_key"])
    return keyed.join(kept, same, "left_semi").dropDuplicates([id_col, own]).drop(own)


_SQL = f"""
with recursive w as (select doc_id, regexp_extract_all(translate(text, '{ascii_uppercase}', '{ascii_lowercase}'), '{WORD}') as k from documents),
  s as (select doc_id, list_distinct(case when coalesce(len(k), 0) = 0 then cast([] as varchar[]) when len(k) < 4 then [array_to_string(k, ' ')]
      else list_transform(range(1, len(k) - 2), lambda i: array_to_string(k[i:i + 3], ' ')) end) as sh from w),
  e as (select doc_id, len(sh) as n, unnest(sh) as x from s),
  l as (select a.doc_id as a, b.doc_id as b from e a join e b on a.x = b.x and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
  r as (select doc_id as id, doc_id as root from s union select l.b, r.root from r join l on r.id = l.a)
select s.doc_id, len(s.sh)::bigint as n_shingles, c.root as component_id, s.doc_id = c.root as kept
from s join (select id, min(root) as root from r group by id) c on s.doc_id = c.id
"""


@query("op3_near_duplicates", _SQL)
def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), words=4).drop("set_key")
