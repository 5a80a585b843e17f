"""De-duplication and data-quality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from difflib import get_close_matches
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.hashing import DEFAULT_SEED, text_key
from reviewloom.functions.text import clean_text
from reviewloom.functions.vectors import all_close
from reviewloom.operators.sampling import sample_n
from reviewloom.operators.tables import SPLITS, drop_null_text
from reviewloom.plans.bounded import fits_broadcast, lookup_join


def add_cleaned(df: DataFrame, col: str) -> DataFrame:
    """Add ``<col>_cleaned`` unless the column is there already."""
    name = f"{col}_cleaned"
    return df if name in df.columns else df.withColumn(name, clean_text(col))


def _group_key(df: DataFrame, cols: Sequence[str]) -> Column:
    """One fixed-width, never-null key per distinct combination, nulls being equal to each other."""
    parts = [F.coalesce(F.hex(text_key(c)), F.lit("-")) for c in cols]
    return F.unhex(F.sha2(F.concat_ws("|", *parts), 256)) if len(parts) > 1 else F.coalesce(text_key(cols[0]), F.lit(b""))


def find_duplicates(df: DataFrame, cols: Sequence[str], count_col: str = "n_copies") -> DataFrame:
    """Every member of every duplicate group, with the size of its group. Nulls count as equal.

    Group sizes come from a map-side combined count on a 32-byte key, so a text copied a billion times
    costs one counter per task. Only the keys of repeated rows go back: broadcast where they were measured small,
    else by a salted join, which spreads a hot text.
    """
    keyed = df.withColumn("_key", _group_key(df, cols))
    groups = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias(count_col)).filter(F.col(count_col) > 1)
    return lookup_join(keyed, groups, "_key").select(*df.columns, count_col)


def drop_duplicates(df: DataFrame, cols: Sequence[str], order: str) -> DataFrame:
    """First row per combination of ``cols`` in the order of a column.

    A null order comes last; of rows that tie in it, the one with the smallest hash over all columns stays.
    Rows are counted on a 32-byte key, and only keys that occur again are looked up: rows whose combination is
    unique are a filtered scan. What is left of the others (first in order) meets by key, combined on the map side.
    """
    keyed = df.withColumn("_key", _group_key(df, cols))
    counted = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_first"))
    again = counted.filter("_n > 1").drop("_n")
    fits = fits_broadcast(again)
    alone = lookup_join(keyed, again.select("_key"), "_key", "left_anti", fits=fits).select(*df.columns)
    ahead = lookup_join(keyed, again, "_key", fits=fits).filter(F.col(order).eqNullSafe(F.col("_first")))
    hashable = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    first = F.min_by(F.struct(*[F.col(c) for c in df.columns]), F.xxhash64(*hashable)).alias("_row")
    return alone.unionByName(ahead.groupBy("_key").agg(first).select("_row.*"))


def clean_dataset(df: DataFrame, id_col: str, text_col: str, order: str | None = None) -> DataFrame:
    """Drop repeated ids, then rows without text."""
    return drop_null_text(drop_duplicates(df, [id_col], order or id_col), text_col)


def cross_dataset_duplicates(df: DataFrame, col: str, source: str) -> DataFrame:
    """Texts that occur more than once in a union of datasets, with the datasets that hold them.

    Rows are counted on a 32-byte key; the texts are fetched for the keys that occur again only.
    """
    keyed = df.filter(F.col(col).isNotNull()).select(text_key(col).alias("_key"), col, source)
    again = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("n_rows"), F.collect_set(source).alias("_in")).filter("n_rows > 1")
    texts = lookup_join(keyed.select("_key", col), again.select("_key"), "_key").groupBy("_key").agg(F.any_value(col).alias(col))
    return texts.join(again, "_key").select(
        col, "n_rows", F.size("_in").cast("bigint").alias("n_sources"), F.array_join(F.array_sort("_in"), ",").alias("sources")
    )


def bad_split(cols: Sequence[str] = SPLITS) -> Column:
    """True unless exactly one of the split flags is set; a null flag counts as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in cols]) != 1


def invalid_splits(df: DataFrame, cols: Sequence[str] = SPLITS) -> DataFrame:
    return df.agg(F.count_if(bad_split(cols)).alias("n_invalid"))


def null_embeddings(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.count_if(F.col(col).isNull()).alias("n_null"), F.count(F.lit(1)).alias("n_rows"))


def embedding_drift(
    old: DataFrame,
    new: DataFrame,
    id_col: str,
    col: str,
    n: int | None = None,
    seed: int = DEFAULT_SEED,
    rtol: float = 1e-5,
    atol: float = 1e-8,
) -> DataFrame:
    """Compare stored with fresh vectors by key: ``(id, is_close)``; a missing vector is not close.

    With ``n`` only the first n stored rows in hash order are compared, the check that the quality gate
    runs before a training job.
    """
    stored = old.select(id_col, F.col(col).alias("_stored"))
    if n is not None:
        stored = sample_n(stored, n, id_col, seed)
    fresh = new.select(id_col, F.col(col).alias("_fresh"))
    close = F.coalesce(all_close("_stored", "_fresh", rtol, atol), F.lit(False))
    return stored.join(fresh, id_col, "left").select(id_col, close.alias("is_close"))


def filter_close_matches(df: DataFrame, col: str, refs: Sequence[str], cutoff: float = 0.8) -> DataFrame:
    """Drop texts that resemble any reference text (Ratcliff-Obershelp ratio at or above the cutoff).

    The ratio cannot exceed ``2 * min(la, lb) / (la + lb)``. That bound runs in the JVM on every row; only
    texts that pass it for some reference go to Python, in Arrow batches, once per distinct text of a
    batch. Rows without text stay.
    """
    refs = list(refs)
    if not refs:
        return df

    @F.pandas_udf("boolean")
    def resembles(texts: pd.Series) -> pd.Series:
        codes, unique = pd.factorize(texts, use_na_sentinel=True)
        hit = [bool(get_close_matches(t, refs, n=1, cutoff=cutoff)) for t in unique]
        return pd.Series([c >= 0 and hit[c] for c in codes])

    length = F.length(col)
    reachable = reduce(
        lambda a, b: a | b,
        [
            2.0 * F.least(length, F.lit(n)) >= F.lit(float(cutoff)) * (length + F.lit(n))
            for n in sorted({len(r) for r in refs})
        ],
    )
    candidate = F.coalesce(reachable, F.lit(False))
    # The UDF sees null for rows that the bound already clears; nulls cost it nothing.
    return (
        df.withColumn("_close", resembles(F.when(candidate, F.col(col))))
        .filter(~F.col("_close"))
        .drop("_close")
    )


def quality_report(
    datasets: Mapping[str, DataFrame] | DataFrame,
    text_col: str,
    split_cols: Sequence[str] = SPLITS,
    drift: Mapping[str, DataFrame] | None = None,
    dataset_col: str = "dataset",
) -> DataFrame:
    """``(dataset, check_name, n_bad)`` for every dataset and one line (``*``) for the union of all.

    ``datasets`` is one frame per name, or a single frame in which ``dataset_col`` names the dataset, null being
    one of its own. All checks come from one count per (text, dataset): a text's counts meet by key, one entry
    per dataset that holds it, and give the lines within and across datasets together. ``drift`` maps dataset
    names to ``embedding_drift`` results.
    """
    if isinstance(datasets, DataFrame):
        datasets = {"": datasets}
        names = {"": F.col(dataset_col).cast("string")}
    else:
        names = {name: F.lit(name) for name in datasets}
    rows = reduce(
        DataFrame.unionByName,
        [
            df.select(
                names[name].alias("dataset"),
                _group_key(df, [text_col]).alias("_key"),
                bad_split(split_cols).cast("long").alias("_bad"),
            )
            for name, df in datasets.items()
        ],
    )
    per_text = rows.groupBy("_key", "dataset").agg(F.count(F.lit(1)).alias("n"), F.sum("_bad").alias("bad"))
    per_key = per_text.groupBy("_key").agg(F.collect_list(F.struct("dataset", "n", "bad")).alias("parts"), F.sum("n").alias("all"))

    def line(dataset: Column, check: str, n: Column) -> Column:
        return F.struct(dataset.cast("string").alias("dataset"), F.lit(check).alias("check_name"), n.cast("long").alias("n_bad"))

    def repeated(n: Column) -> Column:
        return F.when(n > 1, n).otherwise(0)

    across = F.array(line(F.lit("*"), "cross_dataset_duplicates", repeated(F.col("all"))))
    texts = F.transform("parts", lambda p: line(p["dataset"], "duplicate_texts", repeated(p["n"])))
    splits = F.transform("parts", lambda p: line(p["dataset"], "invalid_splits", p["bad"]))
    lines = per_key.select(F.inline(F.concat(texts, splits, across)))
    none = rows.sparkSession.range(1).select(F.inline(F.array(line(F.lit("*"), "cross_dataset_duplicates", F.lit(0)))))
    out = lines.unionByName(none).groupBy("dataset", "check_name").agg(F.sum("n_bad").alias("n_bad"))
    for name, checked in (drift or {}).items():
        out = out.unionByName(
            checked.agg(F.count_if(~F.col("is_close")).alias("n_bad")).select(
                F.lit(name).alias("dataset"), F.lit("embedding_drift").alias("check_name"), "n_bad"
            )
        )
    return out


class QualityGateError(RuntimeError):
    """A data-quality check failed; ``failures`` holds (dataset, check, count) triples."""

    def __init__(self, failures):
        self.failures = failures
        super().__init__("; ".join(f"{d}: {c} = {n}" for d, c, n in failures))


def quality_gate(report: DataFrame) -> None:
    """Stop the job when a report has any finding. The report has a few lines per dataset."""
    bad = report.filter("n_bad > 0").orderBy("dataset", "check_name").collect()
    if bad:
        raise QualityGateError([(r["dataset"], r["check_name"], r["n_bad"]) for r in bad])
