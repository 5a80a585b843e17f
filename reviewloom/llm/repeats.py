"""Removal of repeated passages by a distributed difference-cover method on whole texts.

Positions of a difference cover modulo ``COVER`` are sampled in every text. Any two places with the same 100
bytes have, at one common distance below ``COVER``, two sampled positions with the same next ``NAME`` bytes. So
naming the samples by those bytes and sorting the names finds all places that can repeat (first round). Only
the suffixes around repeated samples remain. They are merged (second round): suffixes are gathered by the
smallest 16-byte gram of their first 100 bytes, which equal suffixes share and neighbours mostly share too, so
runs of suffixes travel as one piece of text. Each gathering sorts its suffixes by their 100-byte prefix and
compares adjacent ones: all but the first of equal prefixes are repeats.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.base import known_powers, prefix_hash, query, span_hash, table
from reviewloom.plans.session import cut_lineage

#: Modulus and differences: every residue is a difference of two of these numbers (a perfect difference set).
COVER = 57
DIFFERENCES = (0, 1, 3, 13, 32, 36, 43, 52)
#: Length of a gram by which suffixes are gathered.
GRAM = 16
#: Bytes that are hashed at once, so that the arrays stay in the processor's cache.
STRIP = 1 << 19
#: Parts of a gathering that is too large for one task.
SPLIT = 64


def packed(values: np.ndarray) -> bytes:
    """Compressed differences of integers."""
    values = np.asarray(values, np.int64)
    with np.errstate(over="ignore"):
        step = np.diff(values, prepend=np.int64(0))
    planes = step.view(np.uint8).reshape(-1, 8).T if len(step) else np.zeros((8, 0), np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1)
    with np.errstate(over="ignore"):
        return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).reshape(-1))


class Texts:
    """The rows of one bucket in order of (id, text), null ids first, as bytes laid end to end."""

    def __init__(self, part: pa.Table):
        part = part.sort_by([("has_id", "ascending"), ("id", "ascending"), ("text", "ascending")])
        self.part = part
        raw = [t.encode("utf-8", "surrogatepass") for t in part["text"].to_pylist()]
        self.size = np.array([len(t) for t in raw], np.int64)
        self.base = np.concatenate(([0], np.cumsum(self.size)))
        self.data = np.frombuffer(b"".join(raw), np.uint8)

    def strips(self) -> Iterator[tuple[int, int]]:
        """Ranges of rows with about STRIP bytes each."""
        a = 0
        while a < len(self.size):
            b = max(a + 1, int(np.searchsorted(self.base, self.base[a] + STRIP, "right")) - 1)
            yield a, b
            a = b


def sampled_names(texts: Texts, name: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, positions in the row, and names of all difference-cover samples, in order."""
    longest = int(texts.size.max(initial=0))
    marks = (np.arange(0, longest + 1, COVER)[:, None] + np.array(DIFFERENCES)).reshape(-1)
    out = []
    for a, b in texts.strips():
        counts = np.searchsorted(marks, texts.size[a:b] - name, "right")
        at = np.concatenate([marks[:n] for n in counts])
        rows = np.repeat(np.arange(a, b), counts)
        data = texts.data[texts.base[a] : texts.base[b]]
        up, down = known_powers(len(data) + 1)
        start = texts.base[rows] - texts.base[a] + at
        out.append((rows, at, span_hash(prefix_hash(data, up), down, start, start + name)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)


def grouped(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions sorted by the leading bits of their hash and by place, and which of them follow an equal one.

    As many leading bits count as the positions leave of 64; sorting numbers that hold both is far cheaper than
    sorting positions.
    """
    low = np.uint64(max(1, int(len(hashes)).bit_length()))
    both = np.sort((hashes >> low << low) | np.arange(len(hashes), dtype=np.uint64))
    order = (both & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    lead = both >> low
    return order, np.concatenate(([False], lead[1:] == lead[:-1])) if len(order) else np.zeros(0, bool)


def first_round(docs: DataFrame, buckets: int, name: int) -> DataFrame:
    """(bucket, rows, positions): per bucket of texts, the samples whose name occurs elsewhere too."""

    def names(part: pa.Table) -> pa.Table:
        texts, out = Texts(part), []
        bucket = part["bucket"][0].as_py()
        rows, at, hashes = sampled_names(texts, name)
        order, same = grouped(hashes)
        here = np.zeros(len(rows), bool)  # names that these texts alone repeat; one place of each is sent
        here[order[same | np.concatenate((same[1:], [False]))[: len(same)]]] = True
        sent = np.ones(len(rows), bool)
        sent[order[same]] = False
        known = packed(rows[here]), packed(at[here])
        to = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
        places = np.flatnonzero(sent)
        places = places[np.argsort(to[places], kind="stable")]
        for own in np.split(places, np.flatnonzero(np.diff(to[places])) + 1):
            if len(own):
                out.append((int(to[own[0]]), bucket, hashes[own].astype(np.uint32).tobytes(), packed(rows[own]), packed(at[own]), *known))
                known = b"", b""
        return _table(out, _NAMES)

    def repeated(part: pa.Table) -> pa.Table:
        columns = part.select(["home", "names", "rows", "at", "known_rows", "known_at"]).to_pylist()
        hashes = np.concatenate([np.frombuffer(r["names"], np.uint32) for r in columns]).astype(np.uint64) << np.uint64(32)
        fresh, old = ([(r["home"], unpacked(r[x]), unpacked(r[y])) for r in columns] for x, y in (("rows", "at"), ("known_rows", "known_at")))
        order, same = grouped(hashes)
        use = np.zeros(len(hashes), bool)
        use[order[same | np.concatenate((same[1:], [False]))]] = True
        use = np.concatenate((use, np.ones(sum(len(x[1]) for x in old), bool)))
        homes = np.concatenate([np.full(len(x[1]), x[0], np.int64) for x in fresh + old])[use]
        rows, at = (np.concatenate([x[k] for x in fresh + old])[use] for k in (1, 2))
        order = np.lexsort((at, rows, homes))
        return _by_home(homes[order], {"rows": rows[order], "at": at[order]})

    sent = docs.groupBy("bucket").applyInArrow(names, _NAMES[0])
    return sent.groupBy("name_bucket").applyInArrow(repeated, _PLACES[0])


_NAMES = (
    "name_bucket int, home int, names binary, rows binary, at binary, known_rows binary, known_at binary",
    [pa.int32(), pa.int32(), *[pa.binary()] * 5],
)
_PLACES = ("bucket int, rows binary, at binary", [pa.int32(), pa.binary(), pa.binary()])
_PIECES = (
    "gram_bucket long, home int, ids binary, rows binary, at binary, sizes binary, bytes binary, known_rows binary, known_at binary, known_ends binary",
    [pa.int64(), pa.int32(), *[pa.binary()] * 8],
)
_RUNS = ("bucket int, rows binary, at binary, ends binary", [pa.int32(), pa.binary(), pa.binary(), pa.binary()])


def _table(rows: list[tuple], shape: tuple[str, list]) -> pa.Table:
    names = [x.split()[0] for x in shape[0].split(", ")]
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, shape[1], strict=True)})


def _by_home(homes: np.ndarray, columns: dict[str, np.ndarray]) -> pa.Table:
    """One row per bucket of texts; ``homes`` ascends."""
    cuts = [0, *(np.flatnonzero(np.diff(homes)) + 1).tolist(), len(homes)]
    rows = [(int(homes[a]), *(packed(v[a:b]) for v in columns.values())) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]
    return _table(rows, _RUNS if len(columns) == 3 else _PLACES)


def _gather(part: pa.Table, *names: str) -> list[np.ndarray]:
    return [np.concatenate([unpacked(x) for x in part[n].to_pylist()] or [np.zeros(0, np.int64)]) for n in names]


def pieces(texts: Texts, rows: np.ndarray, at: np.ndarray, width: int, name: int) -> Iterator[tuple[int, int, int, int]]:
    """(gram, row, start, end) of runs of suffixes around repeated samples that have one smallest gram.

    The run holds the suffixes that start from ``start`` on and have their ``width`` bytes before ``end``.
    """
    grams = width - GRAM + 1
    for row in np.unique(rows).tolist():
        size = int(texts.size[row])
        own = at[rows == row] if len(rows) < 64 else at[np.searchsorted(rows, row) : np.searchsorted(rows, row, "right")]
        near = np.zeros(size + 2, np.int32)
        np.add.at(near, np.maximum(own - (width - name), 0), 1)
        np.add.at(near, own + 1, -1)
        wanted = np.cumsum(near[: size - width + 1]) > 0 if size >= width else np.zeros(0, bool)
        edge = np.diff(np.concatenate(([False], wanted, [False])).astype(np.int8))
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            data = texts.data[texts.base[row] + a : texts.base[row] + b - 1 + width]
            up, down = known_powers(len(data) + 1)
            start = np.arange(len(data) - GRAM + 1)
            hashes = span_hash(prefix_hash(data, up), down, start, start + GRAM)
            least = sliding_argmin(hashes, grams)
            cuts = np.flatnonzero(np.diff(least)) + 1
            for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(least)], strict=True):
                yield int(hashes[least[x]]), row, a + x, a + y - 1 + width


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest value in each window, by doubling."""
    n = len(values)
    best, span = np.arange(n), 1
    while span * 2 <= width:
        right = best[span:]
        left = best[: len(right)]
        best = np.where(values[right] < values[left], right, left)
        span *= 2
    shift = width - span
    left, right = best[: n - width + 1], best[shift : shift + n - width + 1]
    return np.where((values[right] < values[left]) | ((values[right] == values[left]) & (right < left)), right, left)


def second_round(docs: DataFrame, places: DataFrame, buckets: int, width: int, name: int, hot_bytes: int) -> DataFrame:
    """(bucket, rows, at, ends): runs of bytes that are covered by repeats.

    Gatherings beyond ``hot_bytes``, as a very common passage makes them, are split by the suffixes' own hashes.
    """

    def send(part: pa.Table, near: pa.Table) -> pa.Table:
        if not near.num_rows or not part.num_rows:
            return _table([], _PIECES)
        texts = Texts(part)
        bucket = part["bucket"][0].as_py()
        rows, at = _gather(near, "rows", "at")
        order = np.lexsort((at, rows))
        ids = np.array([x if x is not None else -(2**63) for x in texts.part["id"].to_pylist()], np.int64)
        found: dict[int, list] = {}
        for gram, row, a, b in pieces(texts, rows[order], at[order], width, name):
            raw = texts.data[texts.base[row] + a : texts.base[row] + b].tobytes()
            found.setdefault(gram % buckets, []).append((int(ids[row]), row, a, raw))
        return _table([_piece_row(to, bucket, own) for to, own in found.items()], _PIECES)

    def merge(part: pa.Table) -> pa.Table:
        homes, raw, known = [], [], []
        ids, rows, at, sizes = _gather(part, "ids", "rows", "at", "sizes")
        for r in part.select(["home", "sizes", "bytes", "known_rows", "known_at", "known_ends"]).to_pylist():
            homes.append(np.full(len(unpacked(r["sizes"])), r["home"], np.int64))
            raw.append(zstandard.ZstdDecompressor().decompress(r["bytes"]))
            again = [unpacked(r[c]) for c in ("known_rows", "known_at", "known_ends")]
            known.append([np.full(len(again[0]), r["home"], np.int64), *again])
        data = np.frombuffer(b"".join(raw), np.uint8)
        runs = repeated_runs(data, np.concatenate(homes), ids, rows, at, sizes, width)
        home, row, begin, end = (np.concatenate(x) for x in zip(runs, *known, strict=True))
        order = np.lexsort((begin, row, home))
        return _by_home(home[order], {"rows": row[order], "at": begin[order], "ends": end[order]})

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, rows, at, sizes = (unpacked(r[c]) for c in ("ids", "rows", "at", "sizes"))
                data, base = zstandard.ZstdDecompressor().decompress(r["bytes"]), np.concatenate(([0], np.cumsum(sizes)))
                found: dict[int, list] = {0: []}
                for i, row, a, low, size in zip(ids.tolist(), rows.tolist(), at.tolist(), base.tolist(), sizes.tolist(), strict=False):
                    for k in range(size - width + 1):
                        raw = data[low + k : low + k + width]
                        found.setdefault(xxhash.xxh3_64_intdigest(raw) % SPLIT, []).append((i, row, a + k, raw))
                out = [_piece_row(r["gram_bucket"] * SPLIT + sub, r["home"], own) for sub, own in found.items()]
                known = tuple(r[c] for c in ("known_rows", "known_at", "known_ends"))
                out.append((r["gram_bucket"] * SPLIT, r["home"], *[packed([])] * 4, zstandard.ZstdCompressor(level=1).compress(b""), *known))
                yield from _table(out, _PIECES).to_batches()

    sent = docs.groupBy("bucket").cogroup(places.groupBy("bucket")).applyInArrow(send, _PIECES[0])
    sent = cut_lineage(sent, "suffixes")
    loads = sent.groupBy("gram_bucket").agg(F.sum(F.length("bytes")).alias("n")).where(F.col("n") > hot_bytes)
    hot = [r.gram_bucket for r in loads.collect()]
    out = sent.where(~F.col("gram_bucket").isin(hot)).groupBy("gram_bucket").applyInArrow(merge, _RUNS[0])
    if hot:
        finer = sent.where(F.col("gram_bucket").isin(hot)).mapInArrow(split, _PIECES[0])
        out = out.unionByName(finer.groupBy("gram_bucket").applyInArrow(merge, _RUNS[0]))
    return out


def _piece_row(to: int, home: int, own: list[tuple[int, int, int, bytes]]) -> tuple:
    """Pieces (id, row, start, bytes) of one bucket of texts, in order; of equal ones the first, the others as known runs."""
    first: dict[bytes, int] = {}
    for k, (_, _, _, raw) in enumerate(own):
        first.setdefault(raw, k)
    kept = [own[k] for k in first.values()]
    known = [(row, a, a + len(raw)) for k, (_, row, a, raw) in enumerate(own) if first[raw] != k]
    numbers = [packed([x[c] for x in kept]) for c in range(3)]
    text = zstandard.ZstdCompressor(level=1).compress(b"".join(x[3] for x in kept))
    return to, home, *numbers, packed([len(x[3]) for x in kept]), text, *(packed([x[c] for x in known]) for c in range(3))


def repeated_runs(data: np.ndarray, homes: np.ndarray, ids: np.ndarray, rows: np.ndarray, at: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(homes, rows, starts, ends) of runs of repeats: of suffixes with an equal prefix all but the first.

    Pieces are put in order of id, row and place first, so suffixes are numbered in that order.
    """
    order = np.lexsort((at, rows, ids))
    base, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
    windows = sizes - width + 1
    hashes, a = [np.zeros(0, np.uint64)], 0
    while a < len(order):
        b = max(a + 1, int(np.searchsorted(np.cumsum(sizes[a : a + 4096]), STRIP, "right")) + a)
        own = np.concatenate([data[x : x + n] for x, n in zip(base[a:b].tolist(), sizes[a:b].tolist(), strict=True)])
        first = np.repeat(np.cumsum(sizes[a:b]) - sizes[a:b] - (np.cumsum(windows[a:b]) - windows[a:b]), windows[a:b])
        start = first + np.arange(len(first))
        up, down = known_powers(len(own) + 1)
        hashes.append(span_hash(prefix_hash(own, up), down, start, start + width))
        a = b
    hashes = np.concatenate(hashes)
    place, same = grouped(hashes)
    begins = np.maximum.accumulate(np.where(same, 0, np.arange(len(same)))) if len(same) else place
    odd = np.flatnonzero(same & (hashes[place] != hashes[place[begins]]))
    if len(odd):  # leading bits that are shared by chance: sort those few by their whole hashes
        inside = np.flatnonzero(np.isin(begins, begins[odd]))
        inside = inside[np.lexsort((place[inside], hashes[place[inside]]))]
        whole = hashes[place[inside]]
        place = np.concatenate((place[~np.isin(begins, begins[odd])], place[inside]))
        same = np.concatenate((same[~np.isin(begins, begins[odd])], [False], whole[1:] == whole[:-1]))
    again = np.zeros(len(hashes), bool)
    again[place[same]] = True
    piece = np.repeat(np.arange(len(order)), windows)[again]
    where = (np.flatnonzero(again) - (np.cumsum(windows) - windows)[piece]) + at[order][piece]
    home, row = homes[order][piece], rows[order][piece]
    breaks = np.flatnonzero((np.diff(home) != 0) | (np.diff(row) != 0) | (np.diff(where) != 1)) + 1
    begin = np.concatenate(([0], breaks))[: len(home)].astype(int)
    end = np.concatenate((breaks, [len(home)]))[: len(begin)].astype(int) - 1
    return home[begin], row[begin], where[begin], where[end] + width


def remove_repeats(
    docs: DataFrame, width: int = 100, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = 4 << 20, hot_bytes: int = 48 << 20,
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) of every row; ``kept`` holds the remaining UTF-8 bytes.

    A byte goes if a string of ``width`` bytes covers it that also starts earlier: at a smaller id, or earlier in
    the same text. Strings are judged on the input and never cross texts; ``n_spans`` counts the maximal runs
    removed. Null and empty texts have no bytes, and texts shorter than ``width`` stay whole. Rows that share an
    id are ordered by text, rows without an id come first; rows repeated exactly are separate texts, so the
    later ones go. Ids are integers; other columns are not read; an empty table gives no rows.

    Texts are dealt by hash of the id into buckets of about ``bucket_bytes``, so there are as many tasks as the
    table needs. Names have 32 bits besides their bucket's, and a name shared by chance only adds suffixes to
    the second round. Its prefixes are compared by 64-bit hashes among suffixes with one bucket of grams.
    """
    if width < COVER + GRAM:
        raise ValueError(f"width must be at least {COVER + GRAM}")
    spark = docs.sparkSession
    name = width - COVER + 1
    total = docs.agg(F.sum(F.octet_length(text_col)).alias("n"), F.count(F.lit(1)).alias("rows")).first()
    buckets = max(8, math.ceil(((total.n or 0) + 64 * total.rows) / bucket_bytes))
    own = docs.select(
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(buckets)).cast("int").alias("bucket"), F.col(id_col).cast("bigint").alias("id"),
        F.col(id_col).isNotNull().alias("has_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    with released_shuffles(spark):
        places = cut_lineage(first_round(own, buckets, name), "repeated-samples")
        runs = cut_lineage(second_round(own, places, buckets, width, name, hot_bytes), "repeated-runs")

    def cut(part: pa.Table, found: pa.Table) -> pa.Table:
        if not part.num_rows:
            return _table([], shape)
        texts = Texts(part)
        rows, at, ends = _gather(found, "rows", "at", "ends")
        change = np.zeros(len(texts.data) + 1, np.int32)
        np.add.at(change, texts.base[rows] + at, 1)
        np.add.at(change, texts.base[rows] + ends, -1)
        gone = np.cumsum(change[:-1]) > 0
        out = []
        for k, i in enumerate(texts.part["id"].to_pylist()):
            span = slice(texts.base[k], texts.base[k + 1])
            mine = gone[span]
            starts = int(np.count_nonzero(mine[1:] & ~mine[:-1]) + mine[0]) if len(mine) else 0
            out.append((i, len(mine), int(mine.sum()), starts, texts.data[span][~mine].tobytes()))
        return _table(out, shape)

    shape = ("id long, n_bytes long, n_removed long, n_spans long, kept binary", [*[pa.int64()] * 4, pa.binary()])
    out = own.groupBy("bucket").cogroup(runs.groupBy("bucket")).applyInArrow(cut, shape[0])
    return out.withColumnRenamed("id", id_col)


class released_shuffles:
    """Let Spark delete the shuffle files of a query when it ends; what lasts is written to the shared folder."""

    KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession):
        self.conf = spark.conf

    def __enter__(self):
        self.before = self.conf.get(self.KEY, None)
        self.conf.set(self.KEY, "true")

    def __exit__(self, *_):
        self.conf.set(self.KEY, self.before) if self.before is not None else self.conf.unset(self.KEY)


@query("op8_remove_repeats")
def op8_remove_repeats(spark: SparkSession, folder: str) -> DataFrame:
    out = remove_repeats(table(spark, folder, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
