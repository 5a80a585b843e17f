"""Benchmark decontamination: pigeonhole pieces find candidates, Myers' bit-parallel distance decides."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.base import free_name, query, slices, table


def normal(text: str | None) -> str:
    """Lower case, with each run of white space as one blank."""
    return " ".join((text or "").lower().split())


def budget(item: str, max_error: float, min_chars: int) -> int:
    """Edits allowed for a normalised item: a share of its length, none for a short one."""
    return int(len(item) * max_error) if len(item) >= min_chars else 0


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of near equal length; with at most ``errors`` edits one of them stays whole."""
    cuts = [len(item) * k // (errors + 1) for k in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def masks(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for k, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << k
    return out


def least_distance(peq: dict[str, int], m: int, text: str, enough: int) -> int:
    """Least edit distance between a pattern of m characters and any substring of a text (Myers 1999).

    Stops at the first end position whose distance is at most ``enough``.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, m
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best:
                best = score
                if best <= enough:
                    return best
        ph <<= 1
        mh = mh << 1 & full
        pv = (mh | ~(xv | ph)) & full
        mv = ph & xv & full
    return best


class Matcher:
    """All pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], max_error: float, min_chars: int):
        import ahocorasick

        self.items, at = [], {}
        for item_id, raw in items:
            item = normal(raw)
            if not item:
                continue
            errors = budget(item, max_error, min_chars)
            for offset, piece in pieces(item, errors):
                at.setdefault(piece, []).append((len(self.items), offset))
            self.items.append((item_id, item, errors, masks(item), len(item) < min_chars))
        self.automaton = ahocorasick.Automaton()
        for piece, places in at.items():
            self.automaton.add_word(piece, (len(piece), places))
        if at:
            self.automaton.make_automaton()
        self.empty = not at

    def find(self, raw: str | None) -> list[int]:
        """Ids of the items that the text holds within their error budgets, ascending."""
        text, found, tried = normal(raw), set(), set()
        if self.empty or not text:
            return []
        for end, (size, places) in self.automaton.iter(text):
            for k, offset in places:
                if k in found:
                    continue
                item_id, item, errors, peq, alone = self.items[k]
                start = end + 1 - size - offset
                if start >= 0 and text.startswith(item, start) and not (alone and self._inside_word(text, start, len(item))):
                    found.add(k)
                elif errors and (k, start) not in tried:
                    tried.add((k, start))
                    window = text[max(0, start - errors) : max(0, start + len(item) + errors)]
                    if least_distance(peq, len(item), window, errors) <= errors:
                        found.add(k)
        return sorted({self.items[k][0] for k in found})

    @staticmethod
    def _inside_word(text: str, start: int, size: int) -> bool:
        before, after = text[start - 1 : start], text[start + size : start + size + 1]
        return before.isalnum() or after.isalnum()


def find_benchmark_items(
    docs: DataFrame, items: DataFrame, into: str, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    max_error: float = 0.06, min_chars: int = 50, block_bytes: int = 8 << 20,
) -> DataFrame:
    """``docs`` with one more column ``into``: the ascending ids of the benchmark items that each text holds.

    An item is held if some substring of the text is within ``max_error`` of its length in edits, both in lower
    case with white space as single blanks. An item under ``min_chars`` characters must stand there unchanged,
    as whole words. Items are measured first and broadcast in blocks of ``block_bytes``; every block meets every
    document where that document lies, without a shuffle. Null or empty texts and items match nothing, null item
    ids are left out; repeated rows each get their own answer; texts are searched whole.
    """
    spark = docs.sparkSession
    tests = items.where(F.col(item_id).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_id).alias("i"), F.col(item_text).alias("t"))
    size = tests.agg(F.sum(F.octet_length("t") + 64)).first()[0] or 0
    blocks = size // block_bytes + 1
    out = docs.withColumn(into, F.array().cast("array<bigint>"))
    for block in range(blocks):
        own = tests.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block)
        out = _search(out, spark.sparkContext.broadcast([(r.i, r.t) for r in own.collect()]), into, text_col, max_error, min_chars)
    return out


def _search(docs: DataFrame, block, into: str, text_col: str, max_error: float, min_chars: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Matcher(block.value, max_error, min_chars).find
        for batch in slices(batches, text_col):
            at = batch.schema.get_field_index(into)
            hits = [sorted({*old, *find(t)}) for old, t in zip(batch.column(at).to_pylist(), batch.column(text_col).to_pylist(), strict=True)]
            columns = batch.columns
            columns[at] = pa.array(hits, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their columns as they were."""
    into = free_name(docs.columns, "benchmark_items")
    return find_benchmark_items(docs, items, into, text_col, **options).where(F.size(into) == 0).drop(into)


@query("op2_decontaminate")
def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find_benchmark_items(docs, table(spark, folder, "benchmark"), "item_ids")
    return found.select("doc_id", "item_ids", F.size("item_ids").alias("n_items"), (F.size("item_ids") > 0).alias("contaminated"))
