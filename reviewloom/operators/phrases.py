"""Phrases of a gazetteer in running text: a token trie walked in place, or joins where the trie is too large."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions.text import tokens
from reviewloom.plans.bounded import fits_broadcast, lookup_join
from reviewloom.plans.session import cut_lineage

#: A gazetteer up to this size is sent to every executor as a trie.
TRIE_ROWS, TRIE_BYTES = 200_000, 16 * 1024 * 1024
#: Mentions per Arrow batch that leaves the walk.
OUT_ROWS = 20_000

OVERLAPS = ("all", "longest")

_END = ""  # no token is empty, so the empty word can mark the end of a phrase


class TokenTrie:
    """Words as edges; a node where phrases end holds their number."""

    def __init__(self, phrases: Sequence[str]):
        self.root: dict = {}
        for number, phrase in enumerate(phrases):
            node = self.root
            for word in phrase.split(" "):
                node = node.setdefault(word, {})
            node[_END] = number

    def ends(self, words: Sequence[str], start: int) -> Iterator[tuple[int, int]]:
        """``(end, phrase number)`` of every phrase that begins at ``start``, shortest first."""
        node = self.root
        for at in range(start, len(words)):
            node = node.get(words[at])
            if node is None:
                return
            if _END in node:
                yield at + 1, node[_END]

    def mentions(self, words: Sequence[str], longest: bool) -> Iterator[tuple[int, int]]:
        """``(start, phrase number)`` of all phrases, or of the leftmost longest ones that do not overlap."""
        start = 0
        while start < len(words):
            after = start + 1
            if words[start] in self.root:
                found = list(self.ends(words, start))
                if longest and found:
                    after = found[-1][0]
                    found = found[-1:]
                for _, number in found:
                    yield start, number
            start = after


_WORKER: dict[int, tuple[TokenTrie, list[tuple[str, list[str]]]]] = {}


def _worker_trie(shared) -> tuple[TokenTrie, list[tuple[str, list[str]]]]:
    """The trie of a broadcast gazetteer; built once in a worker process, which keeps the last one."""
    if shared.id not in _WORKER:
        entries = shared.value
        _WORKER.clear()
        _WORKER[shared.id] = TokenTrie([phrase for phrase, _ in entries]), entries
    return _WORKER[shared.id]


class _Shared:
    """A broadcast with a number that tells it from others in a worker."""

    def __init__(self, broadcast):
        self.id, self._broadcast = broadcast._jbroadcast.id(), broadcast

    def __getstate__(self):
        return self.id, self._broadcast

    def __setstate__(self, state):
        self.id, self._broadcast = state

    @property
    def value(self):
        return self._broadcast.value


def normalized(gazetteer: DataFrame) -> DataFrame:
    """Distinct ``(phrase, entity)`` with the phrase as lower-case words; phrases without words and nulls go."""
    phrase = F.concat_ws(" ", tokens("phrase")).alias("phrase")
    return gazetteer.filter(F.col("phrase").isNotNull()).select(phrase, "entity").filter("phrase <> ''").distinct()


def phrase_mentions(
    df: DataFrame, id_col: str, text: str, gazetteer: DataFrame, overlaps: str = "all",
    max_rows: int = TRIE_ROWS, max_bytes: int = TRIE_BYTES,
) -> DataFrame:
    """Mentions of gazetteer phrases (``phrase``, ``entity``), matched as words in lower case.

    One row per mention and entity: ``(id, start, entity, phrase)``; ``start`` is the index of the first word.
    ``all``: every phrase at every place. ``longest``: from the left, the longest phrase at a place, then on behind
    its last word; phrases of several entities give a row for each. A row of ``df`` is walked by itself, so
    repeated and null ids keep all their mentions; null texts have none.

    A gazetteer that passes the size check becomes a trie on every executor and the texts stay where they are.
    A larger one is joined: words that open a phrase tell which lengths to look up there.
    """
    if overlaps not in OVERLAPS:
        raise ValueError(f"unknown overlaps: {overlaps}")
    gazetteer = cut_lineage(normalized(gazetteer), "gazetteer")
    words = df.select(F.col(id_col), tokens(text).alias("_w"))
    if fits_broadcast(gazetteer, max_rows, max_bytes):
        return _walked(words, id_col, gazetteer, overlaps == "longest")
    return _joined(words, id_col, gazetteer, overlaps == "longest")


def _walked(words: DataFrame, id_col: str, gazetteer: DataFrame, longest: bool) -> DataFrame:
    # Bounded by the size check above.
    listed = gazetteer.groupBy("phrase").agg(F.collect_list("entity").alias("entities"), F.count_if(F.col("entity").isNull()).alias("bare"))
    entries = [(r["phrase"], [*sorted(r["entities"]), *[None] * r["bare"]]) for r in listed.collect()]
    shared = _Shared(words.sparkSession.sparkContext.broadcast(entries))
    schema = T.StructType(
        [words.schema[id_col], T.StructField("start", T.IntegerType()), T.StructField("entity", T.StringType()), T.StructField("phrase", T.StringType())]
    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, held = _worker_trie(shared)

        def batch(ids, rows):
            places, starts, entities, phrases = zip(*rows)
            columns = [ids.take(pa.array(places, pa.int64())), pa.array(starts, pa.int32()), pa.array(entities, pa.string()), pa.array(phrases, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=[id_col, "start", "entity", "phrase"])

        for part in batches:
            ids, out = part.column(0), []
            for place, cell in enumerate(part.column(1)):
                for start, number in trie.mentions(cell.as_py() or (), longest):
                    phrase, entities = held[number]
                    out.extend((place, start, entity, phrase) for entity in entities)
                    if len(out) >= OUT_ROWS:
                        yield batch(ids, out)
                        out = []
            if out:
                yield batch(ids, out)

    return words.mapInArrow(walk, schema)


_SPANS = T.ArrayType(
    T.StructType([T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType()), T.StructField("phrase", T.StringType())])
)


@F.pandas_udf(_SPANS)
def _leftmost_longest(found: pd.Series) -> pd.Series:
    def chosen(spans):
        free, kept = 0, []
        for span in sorted(spans, key=lambda s: (s["start"], -s["length"])):
            if span["start"] >= free:
                kept.append(span)
                free = span["start"] + span["length"]
        return kept

    return found.map(chosen)


def _joined(words: DataFrame, id_col: str, gazetteer: DataFrame, longest: bool) -> DataFrame:
    # Row numbers are stored with the words, so that a repeated task cannot change them.
    rows = cut_lineage(words.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), "_w"), "words")
    parts = F.split("phrase", " ")
    phrases = gazetteer.select("phrase").distinct()
    openers = phrases.select(parts[0].alias("_opener"), F.size(parts).alias("_n")).groupBy("_opener").agg(F.collect_set("_n").alias("_lengths"))
    places = rows.select("_row", F.posexplode("_w").alias("start", "_opener"))
    opened = lookup_join(places, openers, "_opener", "inner", spread_by=["_row", "start"])
    opened = opened.groupBy("_row").agg(F.collect_list(F.struct("start", "_lengths")).alias("_opened"))

    def spans(place):
        fitting = F.filter(place["_lengths"], lambda n: place["start"] + n <= F.size("_w"))
        return F.transform(
            fitting,
            lambda n: F.struct(place["start"].alias("start"), n.alias("length"), F.concat_ws(" ", F.slice("_w", place["start"] + 1, n)).alias("phrase")),
        )

    spelled = rows.join(opened, "_row").select("_row", "_id", F.explode(F.flatten(F.transform("_opened", spans))).alias("_s")).select("_row", "_id", "_s.*")
    found = lookup_join(spelled, phrases, "phrase", "left_semi", spread_by=["_row", "start"])
    if longest:
        found = found.groupBy("_row").agg(F.first("_id").alias("_id"), F.collect_list(F.struct("start", "length", "phrase")).alias("_s"))
        found = found.select("_id", F.explode(_leftmost_longest("_s")).alias("_s")).select("_id", "_s.*")
    mentions = lookup_join(found, gazetteer, "phrase", "inner", spread_by=["_id", "start"])
    return mentions.select(F.col("_id").alias(id_col), "start", "entity", "phrase")
