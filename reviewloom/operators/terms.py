"""Term statistics and lexicon jobs: distinctive n-grams, frequency gaps, sentiment, spelling, mentions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.text import neighbours, tokens
from reviewloom.plans.bounded import lookup_join
from reviewloom.plans.session import cut_lineage

#: Terms that a sketch tracks at first, and at most, and the size of all that may be broadcast.
TRACKED, MOST_TRACKED = 1 << 17, 1 << 19
#: Sketches that one task merges.
FAN_IN = 64
#: A sketch of frequent items that tracks m of them is off by at most 3.5 / m of all occurrences; an item that it does
#: not name has at most twice that.
SKETCH_ERROR = 3.5


def term_counts(df: DataFrame, terms: Column, by: Sequence[str] = (), name: str = "term") -> DataFrame:
    """Occurrences of every term of an array column; counted on the map side before the shuffle."""
    return df.select(*by, F.explode(terms).alias(name)).groupBy(name, *by).agg(F.count(F.lit(1)).alias("n"))


def class_term_counts(df: DataFrame, y: str, terms: Column, name: str = "term") -> DataFrame:
    """Occurrences of every term in class 1 (``n1``) and in class 0 (``n0``)."""
    label = F.col("_y")
    return (
        df.select(F.col(y).alias("_y"), F.explode(terms).alias(name))
        .groupBy(name)
        .agg(F.count_if(label == 1).alias("n1"), F.count_if(label == 0).alias("n0"))
    )


def distinctive_ngrams(
    df: DataFrame, y: str, text: str, n: int = 2, threshold: int = 15, stopwords: Iterable[str] = ()
) -> DataFrame:
    """N-grams frequent in class 1 that class 0 either never uses or also uses frequently, by difference.

    Frequent means more than ``threshold`` occurrences. N-grams that class 0 uses now and then are left
    out: 1 to ``threshold`` occurrences count against a term, none does not.
    """
    words = df.select(F.col(y).alias("_y"), tokens(text, stopwords).alias("_w"))
    parts = [f"_{i}" for i in range(n)]
    label = F.col("_y")
    # Neighbours are counted as separate columns; only the few that remain are joined to a string.
    counts = (
        words.select("_y", F.explode(neighbours("_w", n, parts)).alias("_g"))
        .select("_y", "_g.*")
        .groupBy(*parts)
        .agg(F.count_if(label == 1).alias("n1"), F.count_if(label == 0).alias("n0"))
    )
    return (
        counts.filter((F.col("n1") > threshold) & ((F.col("n0") == 0) | (F.col("n0") > threshold)))
        .select(F.concat_ws(" ", *parts).alias("ngram"), "n1", "n0", (F.col("n1") - F.col("n0")).alias("diff"))
        .orderBy(F.col("diff").desc(), "ngram")
    )


def freq_difference(counts: DataFrame, k: int = 10, mode: str = "signed", name: str = "term") -> DataFrame:
    """The k terms that differ most between the classes, from ``class_term_counts``.

    ``signed``: largest class-1 surplus, a missing term counting 0. ``abs``: largest difference either
    way, among the terms that both classes use.
    """
    gaps = counts.withColumn("diff", F.col("n1") - F.col("n0"))
    if mode == "abs":
        gaps = gaps.filter((F.col("n1") > 0) & (F.col("n0") > 0))
        return gaps.orderBy(F.abs("diff").desc(), name).limit(k)
    if mode == "signed":
        return gaps.filter((F.col("n1") > 0) | (F.col("n0") > 0)).orderBy(F.col("diff").desc(), name).limit(k)
    raise ValueError(f"unknown mode: {mode}")


def feature_means(df: DataFrame, y: str, features: Sequence[str]) -> DataFrame:
    return df.groupBy(y).agg(*[F.avg(f).alias(f"avg_{f}") for f in features])


def misspellings(df: DataFrame, id_col: str, text: str, dictionary: DataFrame) -> DataFrame:
    """Number of distinct words per text that a dictionary (``token``) does not know; 0 is included.

    The outer explode keeps texts without words, so the counts come out of one aggregate and need no join
    back to the texts.
    """
    words = df.select(id_col, F.explode_outer(F.array_distinct(tokens(text))).alias("token"))
    known = dictionary.select(F.explode(tokens("token")).alias("token")).distinct().withColumn("_known", F.lit(True))
    marked = lookup_join(words, known, "token", "left", spread_by=[id_col])
    unknown = F.col("token").isNotNull() & F.col("_known").isNull()
    return marked.groupBy(id_col).agg(F.count_if(unknown).alias("misspellings"))


def lexicon_sentiment(df: DataFrame, id_col: str, text: str, lexicon: DataFrame) -> DataFrame:
    """Mean polarity of the words that a lexicon (``token``, ``polarity``) knows; 0 without any."""
    words = df.select(id_col, F.explode_outer(tokens(text)).alias("token"))
    scored = lookup_join(words, lexicon.select(F.lower("token").alias("token"), "polarity"), "token", "left", spread_by=[id_col])
    return scored.groupBy(id_col).agg(F.coalesce(F.avg("polarity"), F.lit(0.0)).alias("sentiment"))


def tag_terms(df: DataFrame, y: str, text: str, tags: DataFrame) -> DataFrame:
    """Occurrences of each tag of a lexicon (``token``, ``tag``) in class 1 and class 0.

    Words are counted per class first, so the lexicon meets the vocabulary and not the running text.
    """
    vocabulary = class_term_counts(df, y, tokens(text), "token")
    tagged = lookup_join(vocabulary, tags.select(F.lower("token").alias("token"), "tag"), "token", "inner", spread_by=["n1", "n0"])
    return tagged.groupBy("tag").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def modifier_pairs(df: DataFrame, id_col: str, text: str, modifiers: DataFrame) -> DataFrame:
    """Neighbouring words whose first one is a known modifier (``token``): ``(id, pos, modifier, head)``."""
    words = df.select(id_col, tokens(text).alias("_w"))
    pairs = neighbours("_w", 2, ["token", "head"])
    rows = words.select(id_col, F.posexplode(pairs).alias("pos", "_p")).select(id_col, "pos", "_p.*")
    found = lookup_join(rows, modifiers.select(F.lower("token").alias("token")).distinct(), "token", "inner", spread_by=[id_col, "pos"])
    return found.select(id_col, "pos", F.col("token").alias("modifier"), "head")


def vocabulary(df: DataFrame, text: str, size: int = 10_000, pattern: str = r"[\p{L}\p{N}_]{2,}") -> DataFrame:
    """The most frequent terms of two or more word characters, ties in alphabetical order."""
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(pattern), F.lit(0))
    return term_counts(df, words).orderBy(F.col("n").desc(), "term").limit(size)


def _sketched(words: DataFrame, name: str, tracked: int) -> tuple[DataFrame, int]:
    """Terms that a sketch names, stored, and the number of all occurrences."""
    tasks = words.rdd.getNumPartitions()
    begin = F.expr(f"approx_top_k_accumulate({name}, {tracked})").alias("sketch")
    merge = F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch")
    # A tree: no task merges more than FAN_IN sketches, however many tasks made them.
    groups = -(-tasks // FAN_IN)
    part = words.withColumn("_part", F.spark_partition_id() % groups)
    level = part.groupBy("_part").agg(begin, F.count(name).alias("total"))
    while groups > 1:
        groups = -(-groups // FAN_IN)
        level = level.groupBy((F.col("_part") % groups).alias("_part")).agg(merge, F.sum("total").alias("total"))
    top = F.expr(f"approx_top_k_estimate(sketch, {tracked})").alias("top")
    stored = cut_lineage(level.select(top, "total"), "sketch")
    total = stored.agg(F.sum("total")).first()[0] or 0
    return stored.select(F.explode("top").alias("_t")).select(F.col("_t.item").alias(name)), total


def frequent_terms(df: DataFrame, terms: Column, k: int, name: str = "term", tracked: int = TRACKED) -> DataFrame:
    """The ``k`` most frequent terms of an array column with exact counts ``n``, ties in order of the term.

    The same rows as sorting ``term_counts``, but the long tail does not move: every task keeps a sketch of ``tracked``
    terms, the sketches are merged in a tree, and only terms that the merged one names are counted, where the texts lie. A
    term that it does not name stays below a known number of occurrences; if the k-th count is above that, or the
    named terms make up all occurrences, nothing can be missing. If not, the sketch grows fourfold, and beyond
    ``MOST_TRACKED`` terms all are counted by a shuffle. Null terms are left out; without terms there are no rows.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    words = df.select(F.explode(terms).alias(name)).filter(F.col(name).isNotNull())
    best = [F.col("n").desc(), name]
    tracked = max(tracked, k)
    while tracked <= MOST_TRACKED:
        named, total = _sketched(words, name, tracked)
        # A sketch holds at most `tracked` terms, but terms can be long: the join looks at their size.
        met = lookup_join(words, named, name, spread_by=[name], max_rows=MOST_TRACKED)
        counted = cut_lineage(met.groupBy(name).agg(F.count(F.lit(1)).alias("n")), "frequent")
        top = counted.orderBy(*best).limit(k)
        least = top.agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("n")).first()
        beyond = least["rows"] == k and least["n"] > 2 * SKETCH_ERROR * total / tracked
        if beyond or total == (counted.agg(F.sum("n")).first()[0] or 0):
            return top
        tracked *= 4
    return words.groupBy(name).agg(F.count(F.lit(1)).alias("n")).orderBy(*best).limit(k)
