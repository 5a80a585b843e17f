"""Text augmentation as column expressions: sentence shuffling and word substitution."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.hashing import DEFAULT_SEED, seed_hash, uniform
from reviewloom.functions.text import sentences, strip
from reviewloom.operators.tables import split_slice, with_label
from reviewloom.plans.bounded import bounded_rows, lookup_join

MAX_LITERAL_SYNONYMS = 1_000


@dataclass(frozen=True)
class Rewriter:
    """Makes one new text per copy number.

    ``rewrite`` gets the row's id, its text, what ``prepare`` made of the text (once per row) and the copy
    number; null means that it failed.
    """

    rewrite: Callable[[Column, Column, Column, Column], Column]
    prepare: Callable[[Column], Column] = lambda text: text


def _trimmed_sentences(text: Column) -> Column:
    return F.transform(sentences(text), lambda s: strip(s))


def shuffled_sentences(seed: int = DEFAULT_SEED) -> Rewriter:
    """Sentences in hash order, joined by ``". "``; a text with fewer than two stays as it is."""

    def rewrite(row_id: Column, text: Column, pieces: Column, copy: Column) -> Column:
        keyed = F.transform(pieces, lambda s, i: F.struct(seed_hash(seed, row_id, copy, i).alias("h"), s.alias("s")))
        joined = F.array_join(F.sort_array(keyed)["s"], ". ")
        return F.when(F.size(pieces) < 2, text).otherwise(joined)

    return Rewriter(rewrite, _trimmed_sentences)


def substituted_words(
    synonyms: Mapping[str, str], rate: float = 0.05, stopwords: Iterable[str] = (), seed: int = DEFAULT_SEED
) -> Rewriter:
    """Swap a seeded share of the non-stop-words for their synonyms, sentence by sentence.

    Words are what single spaces separate, looked up in lower case; blank sentences disappear and the
    rest is re-joined by ``". "``. For dictionaries of up to a thousand entries; ``substitute_words``
    takes any size.
    """
    stop = set(stopwords)
    table = {word: synonym for word, synonym in sorted(synonyms.items()) if word not in stop}
    if not table:
        table = {"": ""}
    replacement = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    known = list(table)

    def rewrite(row_id: Column, text: Column, pieces: Column, copy: Column) -> Column:
        def word(w: Column, i: Column, j: Column) -> Column:
            # The draw is made only for words that could change.
            swap = F.lower(w).isin(known) & (uniform(seed, row_id, copy, i, j) < F.lit(rate))
            return F.when(swap, F.coalesce(F.try_element_at(replacement, F.lower(w)), w)).otherwise(w)

        def sentence(s: Column, i: Column) -> Column:
            return F.array_join(F.transform(F.split(s, " "), lambda w, j: word(w, i, j)), " ")

        return F.array_join(F.transform(pieces, sentence), ". ")

    return Rewriter(rewrite, _trimmed_sentences)


def _made(df: DataFrame, id_col: str, text_col: str, rewriter: Rewriter, n: int) -> DataFrame:
    """``(id, _made)``: the n new texts of each row, or null when any of them is."""
    rows = df.select(id_col, text_col, rewriter.prepare(F.col(text_col)).alias("_prepared"))
    made = [rewriter.rewrite(F.col(id_col), F.col(text_col), F.col("_prepared"), F.lit(k)) for k in range(1, n + 1)]
    rows = rows.select(id_col, F.array(*made).alias("_made"))
    return rows.select(id_col, F.when(F.forall("_made", lambda t: t.isNotNull()), F.col("_made")).alias("_made"))


def copies(df: DataFrame, id_col: str, text_col: str, rewriter: Rewriter, n: int) -> DataFrame:
    """``(id, copy, text)``: n new texts per row. A row for which any copy is null has failed and is left out."""
    # An outer explode and a filter behind it: a filter in front would be pushed down and make every text twice.
    return (
        _made(df, id_col, text_col, rewriter, n)
        .select(id_col, F.posexplode_outer("_made").alias("copy", text_col))
        .filter(F.col("copy").isNotNull())
        .withColumn("copy", F.col("copy") + 1)
    )


def augment_counts(df: DataFrame, id_col: str, text_col: str, rewriter: Rewriter, n: int) -> DataFrame:
    """``(seen, succeeded)`` rows of an augmentation."""
    return _made(df, id_col, text_col, rewriter, n).agg(
        F.count(F.lit(1)).alias("seen"), F.count("_made").alias("succeeded")
    )


def shuffle_sentences(df: DataFrame, id_col: str, text_col: str, n: int = 1, seed: int = DEFAULT_SEED) -> DataFrame:
    return copies(df, id_col, text_col, shuffled_sentences(seed), n)


def substitute_words(
    df: DataFrame,
    id_col: str,
    text_col: str,
    synonyms: DataFrame,
    n: int = 1,
    rate: float = 0.05,
    stopwords: Iterable[str] = (),
    seed: int = DEFAULT_SEED,
    max_literal: int = MAX_LITERAL_SYNONYMS,
) -> DataFrame:
    """``(id, copy, text)`` with words swapped by a ``(token, synonym)`` table of any size.

    A short table becomes a literal, and rows never move. Beyond that only the drawn words, ``rate`` of
    all, are exploded, looked up and handed back to their text by position and word, so rows that share an id
    get the same words as on the short path.
    """
    pairs = synonyms.groupBy("token").agg(F.min("synonym").alias("synonym"))
    rows = bounded_rows(pairs, max_literal)
    if rows is not None:
        table = {r["token"]: r["synonym"] for r in rows}
        return copies(df, id_col, text_col, substituted_words(table, rate, stopwords, seed), n)
    stop = sorted(set(stopwords))
    split_up = F.transform(sentences(text_col), lambda s: F.split(strip(s), " "))
    pieces = df.filter(F.col(text_col).isNotNull()).select(id_col, split_up.alias("_s"))
    every = pieces.select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("copy"))
    marked = F.flatten(
        F.transform(
            "_s",
            lambda s, i: F.transform(
                s,
                lambda w, j: F.struct(
                    i.alias("i"),
                    j.alias("j"),
                    F.lower(w).alias("token"),
                    (uniform(seed, F.col(id_col), F.col("copy"), i, j) < F.lit(rate)).alias("hit"),
                ),
            ),
        )
    )
    drawn = F.filter(marked, lambda m: m["hit"] & ~m["token"].isin(stop) if stop else m["hit"])
    words = every.select(id_col, "copy", F.explode(drawn).alias("_m")).select(id_col, "copy", "_m.i", "_m.j", "_m.token")
    found = lookup_join(words, pairs, "token", "inner", spread_by=[id_col, "copy", "i", "j"])
    swaps = found.groupBy(F.col(id_col).alias("_of"), F.col("copy").alias("_nth")).agg(
        F.map_from_entries(F.collect_set(F.struct(F.struct("i", "j", "token"), "synonym"))).alias("_swaps")
    )
    rebuilt = F.array_join(
        F.transform(
            "_s",
            lambda s, i: F.array_join(
                F.transform(
                    s,
                    lambda w, j: F.coalesce(
                        F.try_element_at(F.col("_swaps"), F.struct(i.alias("i"), j.alias("j"), F.lower(w).alias("token"))), w
                    ),
                ),
                " ",
            ),
        ),
        ". ",
    )
    own = F.col(id_col).eqNullSafe(F.col("_of")) & (F.col("copy") == F.col("_nth"))
    return every.join(swaps, own, "left").select(id_col, "copy", rebuilt.alias(text_col))


def augment_dataset(df: DataFrame, id_col: str, text_col: str, rewriter: Rewriter, n: int) -> DataFrame:
    """An augmented dataset: n new texts per seed row under the seed's id."""
    return copies(df, id_col, text_col, rewriter, n).drop("copy")


def augment_train(
    df: DataFrame, id_col: str, text_col: str, rewriter: Rewriter, n: int, label_col: str, label
) -> DataFrame:
    """Augment training rows only; the result carries the label and belongs to the training split alone."""
    made = augment_dataset(split_slice(df, "train"), id_col, text_col, rewriter, n)
    out = with_label(made, label_col, label)
    return out.withColumns({"train": F.lit(1), "test": F.lit(0), "val": F.lit(0)})
