"""Toxicity: a learned lexicon in a trie, met by Levenshtein automata, with scores by context window."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from reviewloom.llm.base import free_name, query, slices, table
from reviewloom.plans.session import cut_lineage

TOKEN = re.compile(r"[^\W_](?:[\w@$*]*[^\W_])?")
#: Quotation marks; a hit between two of them on one line, ``WINDOW`` characters apart at most, is quoted.
OPENING, CLOSING, WINDOW = '"“„«»‹', '"”“«»›', 80
_BEFORE = re.compile(rf"[{OPENING}][^{OPENING}{CLOSING}\n]*\Z")
_AFTER = re.compile(rf"[^{OPENING}{CLOSING}\n]*[{CLOSING}]")
STEMS = range(3, 8)


def edits(term: str, stem: bool) -> int:
    """Misspellings allowed: none for short entries, one from five characters on, two from nine; one less for stems."""
    return max(0, (len(term) >= 5) + (len(term) >= 9) - stem)


class LexiconAutomaton:
    """The intersection of the lexicon's trie with a Levenshtein automaton, made deterministic as words are read.

    A state is a set of (trie node, edits so far); its moves are worked out once and remembered. Most words
    reach the dead state within a few characters.
    """

    def __init__(self, entries: dict[str, bool]):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[list[tuple[str, int, bool]]] = [[]]
        self.reach = [0]  # the largest budget at or below a node
        for term, stem in entries.items():
            node, k = 0, edits(term, stem)
            self.reach[0] = max(self.reach[0], k)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append([])
                    self.reach.append(0)
                node = self.children[node][c]
                self.reach[node] = max(self.reach[node], k)
            self.term[node].append((term, k, stem))
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.found: list[tuple[str, int] | None] = []  # best entry if the word ends here
        self.stem: list[tuple[str, int] | None] = []  # best stem that has been read
        self.dead = self._state(frozenset())
        self.start = self._state(self._skips({0: 0}))

    def _skips(self, least: dict[int, int]) -> frozenset:
        todo = list(least.items())
        while todo:
            node, e = todo.pop()
            if e > least[node]:
                continue
            for child in self.children[node].values():
                if e + 1 <= self.reach[child] and e + 1 < least.get(child, 99):
                    least[child] = e + 1
                    todo.append((child, e + 1))
        return frozenset(least.items())

    def _state(self, nodes: frozenset) -> int:
        if nodes not in self.ids:
            self.ids[nodes] = len(self.sets)
            self.sets.append(nodes)
            self.moves.append({})
            ends = [(e, term, stem) for node, e in nodes for term, k, stem in self.term[node] if e <= k]
            best = lambda x: (lambda m: (m[1], m[0]) if m else None)(min(x, default=None))
            self.found.append(best((e, t) for e, t, _ in ends))
            self.stem.append(best((e, t) for e, t, s in ends if s))
        return self.ids[nodes]

    def _move(self, state: int, c: str) -> int:
        least: dict[int, int] = {}
        for node, e in self.sets[state]:
            steps = [(child, e + (c != x)) for x, child in self.children[node].items()]
            for target, cost in [*steps, (node, e + 1)]:
                if cost <= self.reach[target] and cost < least.get(target, 99):
                    least[target] = cost
        out = self.moves[state][c] = self._state(self._skips(least))
        return out

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest entry within its budget, with its distance; a stem may be followed by anything."""
        state, read = self.start, None
        for c in word:
            state = self.moves[state].get(c)
            if state is None:
                return self._match_slowly(word)
            if state == self.dead:
                return read
            read = read or self.stem[state]
        found = self.found[state]
        return min((x for x in (found, read) if x), key=lambda x: (x[1], x[0]), default=None)

    def _match_slowly(self, word: str) -> tuple[str, int] | None:
        state, read = self.start, None
        for c in word:
            at = self.moves[state].get(c)
            state = self._move(state, c) if at is None else at
            if state == self.dead:
                return read
            read = read or self.stem[state]
        found = self.found[state]
        return min((x for x in (found, read) if x), key=lambda x: (x[1], x[0]), default=None)


def quoted(text: str, start: int, end: int) -> bool:
    return bool(_BEFORE.search(text[max(0, start - WINDOW) : start]) and _AFTER.match(text[end : end + WINDOW]))


class Finder:
    """Finds entries in texts; remembers the answers for words it has seen, up to ``room`` of them."""

    def __init__(self, entries: dict[str, bool], room: int = 400_000):
        self.automaton, self.known, self.room = LexiconAutomaton(entries), {}, room

    def find(self, text: str | None) -> dict[tuple[str, str, int], bool]:
        """(entry, word, distance) of each hit, with whether all of its places are quoted."""
        low = (text or "").lower()
        if len(self.known) > self.room:
            self.known = {}
        known, words = self.known, set(TOKEN.findall(low))
        for w in words.difference(known):
            known[w] = self.automaton.match(w)
        hits = {w: known[w] for w in words if known[w]}
        out: dict[tuple[str, str, int], bool] = {}
        if hits:
            marked = any(c in low for c in set(OPENING + CLOSING))
            for m in TOKEN.finditer(low):
                if m[0] in hits:
                    key = (hits[m[0]][0], m[0], hits[m[0]][1])
                    out[key] = out.get(key, True) and marked and quoted(low, m.start(), m.end())
        return out


@dataclass
class Model:
    """A lexicon (entry: is it a stem), the chance that a hit marks a toxic text, and the chance without a hit."""

    entries: dict[str, bool] = field(default_factory=dict)
    chance: dict[tuple[str, bool], float] = field(default_factory=dict)  # exact hits by entry and quotation
    near: dict[tuple[int, bool], float] = field(default_factory=dict)  # others by distance and quotation
    words: dict[str, float] = field(default_factory=dict)  # other spellings seen in training
    base: float = 0.05

    def hit(self, entry: str, word: str, distance: int, in_quotes: bool) -> float:
        if not distance:
            return self.chance.get((entry, in_quotes), self.base)
        p = self.near.get((distance, in_quotes), self.base)
        return min(p, self.words[word]) if word in self.words and in_quotes else self.words.get(word, p)

    def score(self, hits: dict[tuple[str, str, int], bool]) -> float:
        """The strongest entry's chance, raised by further entries that are likelier toxic than not."""
        by_entry: dict[str, float] = defaultdict(float)
        for (entry, word, distance), in_quotes in hits.items():
            by_entry[entry] = max(by_entry[entry], self.hit(entry, word, distance, in_quotes))
        chances = sorted(by_entry.values(), reverse=True)
        if not chances or chances[0] <= self.base:
            return self.base
        clean = 1 - chances[0]
        for p in chances[1:]:
            clean *= 1 - p if p > 0.5 else 1
        return 1 - clean


def held_out(id_col: str) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))


def _wilson(k: float, n: float, z: float = 2.0) -> float:
    p = k / n
    return (p + z * z / 2 / n - z * math.sqrt(p * (1 - p) / n + z * z / 4 / n / n)) / (1 + z * z / n)


def _parts(word: str) -> list[str]:
    """A word, and its stems with an asterisk."""
    return [word, *(f"{word[:k]}*" for k in STEMS if len(word) >= k)]


def _lexicon(sample: DataFrame, min_docs: int, min_precision: float, max_terms: int) -> dict[str, bool]:
    """Words and stems that mark toxic texts, in many different surroundings, so that copies of one text don't count."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            seen = [Counter(), Counter()]
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                seen[toxic].update({p for w in set(TOKEN.findall(text.lower())) for p in _parts(w)})
            names = list(seen[0] | seen[1])
            yield pa.RecordBatch.from_pydict({"part": names, "neg": [seen[0][x] for x in names], "pos": [seen[1][x] for x in names]})

    total = sample.mapInArrow(counts, "part string, neg long, pos long").groupBy("part").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))
    strong = total.where((F.col("pos") >= min_docs) & (F.col("pos") >= 2 * F.col("neg"))).collect()
    rated = {r.part: (r.pos, r.neg) for r in strong if _wilson(r.pos, r.pos + r.neg) >= min_precision}
    shared = sample.sparkSession.sparkContext.broadcast(frozenset(rated))

    def surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = set()
            for text in batch.column("text").to_pylist():
                words = TOKEN.findall(text.lower())
                for i, w in enumerate(words):
                    for p in _parts(w):
                        if p in shared.value:
                            sides = " ".join(words[max(0, i - 1) : i]) + "\0" + " ".join(words[i + 1 : i + 2])
                            rows.add((p, xxhash.xxh3_64_intdigest(sides) >> 1))
            parts, sides = zip(*rows, strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.string()), pa.array(sides, pa.int64())], names=["part", "sides"])

    around = sample.where("toxic = 1").mapInArrow(surroundings, "part string, sides long").groupBy("part").agg(F.countDistinct("sides").alias("n"))
    wide = {r.part: r.n for r in around.collect()}
    good = [p for p, (pos, _) in rated.items() if wide.get(p, 0) >= max(min_docs, 0.3 * pos)]
    good.sort(key=lambda p: (-rated[p][0], rated[p][1], not p.endswith("*"), -len(p), p))
    entries: dict[str, bool] = {}
    for p in good:
        word, stem = p.removesuffix("*"), p.endswith("*")
        if len(entries) >= max_terms:
            break
        if any(s and word.startswith(q) for q, s in entries.items()):
            continue
        if stem:  # a stem must mark texts beyond those of the strongest part that it contains
            pos, neg = max((rated[q] for q in good if q != p and q.startswith(word)), default=(0, 0))
            rest = rated[p][0] - pos, rated[p][1] - min(neg, rated[p][1])
            if rest[0] < min_docs or _wilson(rest[0], sum(rest)) < min_precision:
                continue
        entries[word] = stem
    return entries


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        fit_rows: int = 20_000, min_docs: int = 8, min_precision: float = 0.6, max_terms: int = 2_000) -> Model:
    """Learn from at most ``fit_rows`` labelled rows outside the held-out quarter, taken in hash order of the id.

    Labels other than 0 and 1, null ids and null texts teach nothing; repeated labels of an id count once, and
    as toxic if any is. Without labels the lexicon is empty and every text gets the same low score.
    """
    marks = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    marks = marks.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))
    marks = marks.orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(fit_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    sample = cut_lineage(texts.join(F.broadcast(marks), "id").select("text", "toxic"), "toxic-sample")
    entries = _lexicon(sample, min_docs, min_precision, max_terms)
    shared = sample.sparkSession.sparkContext.broadcast(entries)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shared.value)
        for batch in slices(batches, "text"):
            seen: Counter = Counter()
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                hits = finder.find(text)
                seen.update({("none", "", 0, False, toxic)} if not hits else ())
                seen.update({("entry" if not d else "word", e if not d else w, d, q, toxic) for (e, w, d), q in hits.items()})
            kinds, names, distances, marked, toxics = zip(*seen, strict=True) if seen else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array(names, pa.string()), pa.array(distances, pa.int32()), pa.array(marked, pa.bool_()),
                 pa.array(toxics, pa.int32()), pa.array(seen.values(), pa.int64())],
                names=["kind", "name", "distance", "quoted", "toxic", "n"],
            )

    schema = "kind string, name string, distance int, quoted boolean, toxic int, n long"
    grid = sample.mapInArrow(cells, schema).groupBy("kind", "name", "distance", "quoted").agg(
        F.sum(F.col("n") * F.col("toxic")).alias("pos"), F.sum("n").alias("n")
    )
    return _calibrate(entries, [tuple(r) for r in grid.collect()])


def _calibrate(entries: dict[str, bool], grid: list[tuple]) -> Model:
    """Chances from the counts (kind, name, distance, quoted, toxic texts, texts) of the fitted rows.

    What has few counts leans on its distance and quotation: unseen quotations on half the plain chance, new
    misspellings on those that were seen once.
    """
    model = Model(entries)
    none = [(pos, n) for kind, _, _, _, pos, n in grid if kind == "none"]
    model.base = min(0.25, (sum(p for p, _ in none) + 0.5) / (sum(n for _, n in none) + 10))
    for in_quotes in (False, True):
        for distance in (0, 1, 2):
            own = [(pos, n) for kind, _, d, q, pos, n in grid if kind != "none" and d == distance and q == in_quotes]
            rare = [(pos, n) for pos, n in own if n <= 2] if distance else own
            lean = (0.6, 0.4, 0.2)[distance] if not in_quotes else model.near[distance, False] / 2
            model.near[distance, in_quotes] = (sum(p for p, _ in rare) + 4 * lean) / (sum(n for _, n in rare) + 4)
        for entry in entries:
            k, n = next(((pos, n) for kind, e, _, q, pos, n in grid if kind == "entry" and e == entry and q == in_quotes), (0, 0))
            model.chance[entry, in_quotes] = (k + 2 * model.near[0, in_quotes]) / (n + 2)
    spelled: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0])
    for kind, word, distance, _, pos, n in grid:
        if kind == "word":
            spelled[word] = [spelled[word][0] + pos, spelled[word][1] + n, distance]
    model.words = {w: (k + 2 * model.near[d, False]) / (n + 2) for w, (k, n, d) in spelled.items()}
    return model


def score(docs: DataFrame, model: Model, into: str, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``into``: the chance from 0 to 1 that the whole text is toxic.

    Only the text counts. Null and empty texts get the chance of a text without any hit. Rows, ids and other
    columns stay as they are, repeated rows and clashing names included. One pass, no shuffle; the model that is
    broadcast holds at most ``max_terms`` entries and the spellings of the fitted rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(**shared.value)
        finder = Finder(own.entries)
        for batch in slices(batches, text_col):
            out = np.array([own.score(finder.find(t)) for t in batch.column(text_col).to_pylist()], float)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, into])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(into, DoubleType())]))


def drop_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text", threshold: float = 0.3, **options) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with their columns as they were."""
    into = free_name(docs.columns, "toxic_score")
    return score(docs, fit(docs, labels, text_col=text_col, **options), into, text_col).where(F.col(into) < threshold).drop(into)


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, folder, "labels")), "score")
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )
