"""Moderation of whole tables: rule columns, saved models, mistakes and re-assessment of old runs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.hashing import DEFAULT_SEED
from reviewloom.functions.scores import SEVERITY, lookup, severity
from reviewloom.functions.text import clean_text, has_word, tokens
from reviewloom.functions.vectors import top_class
from reviewloom.operators import metrics as M
from reviewloom.operators.external import embed, embedding_column
from reviewloom.operators.quality import add_cleaned
from reviewloom.operators.sampling import balance
from reviewloom.operators.tables import concat_datasets
from reviewloom.operators.train import load_model, score


@dataclass(frozen=True)
class Rule:
    """One moderation rule: a column worked out from the cleaned text and its words; above 0 means flagged."""

    name: str
    column: Callable[[Column, Column], Column]


def _lower(words: Sequence[str]) -> list[str]:
    """Word lists in the form of the cleaned text."""
    return [w.strip().lower() for w in words]


def keyword_rule(name: str, keywords: Sequence[str]) -> Rule:
    """1 when any of the words or phrases occurs."""
    return Rule(name, lambda text, words: has_word(text, _lower(keywords)).cast("int"))


def severity_rule(name: str, strong: Sequence[str], possible: Sequence[str]) -> Rule:
    """2, 1 or 0 by the strongest group of words that occurs."""
    return Rule(name, lambda text, words: F.when(has_word(text, _lower(strong)), 2).when(has_word(text, _lower(possible)), 1).otherwise(0))


def lacks_rule(name: str, keywords: Sequence[str]) -> Rule:
    """1 when none of the words occurs, e.g. no first-person word in something that is not an experience."""
    return Rule(name, lambda text, words: (~has_word(text, _lower(keywords))).cast("int"))


def mentions_rule(name: str, names: Sequence[str]) -> Rule:
    """Number of words that are one of the names."""
    wanted = sorted({n.lower() for n in names})
    return Rule(name, lambda text, words: F.size(F.filter(words, lambda w: w.isin(wanted))))


def pairs_rule(name: str, modifiers: Sequence[str]) -> Rule:
    """Number of words that directly follow a modifier."""
    wanted = sorted({m.lower() for m in modifiers})

    def count(text: Column, words: Column) -> Column:
        heads = F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0)))
        return F.size(F.filter(heads, lambda w: w.isin(wanted)))

    return Rule(name, count)


def moderate(df: DataFrame, text_col: str, rules: Sequence[Rule | Callable[[DataFrame], DataFrame]], threshold: int = 0) -> DataFrame:
    """One column per rule and ``flagged``, in one pass over the table.

    The text is cleaned and split into words once for all rules. A rule is a ``Rule`` or a function that
    adds columns to the frame (a saved model, an endpoint) and names its flag column in ``flag_col``.
    """
    out = df.withColumn("_clean", clean_text(text_col)).withColumn("_words", tokens("_clean"))
    out = out.withColumns({r.name: r.column(F.col("_clean"), F.col("_words")) for r in rules if isinstance(r, Rule)})
    flags: list[str] = []
    for rule in rules:
        if not isinstance(rule, Rule):
            out = rule(out)
        flags.append(rule.name if isinstance(rule, Rule) else rule.flag_col)
    anything = reduce(lambda a, b: a | b, [F.coalesce(F.col(f), F.lit(0)) > threshold for f in flags])
    return out.withColumn("flagged", anything).drop("_clean", "_words")


def complaints_rule(df: DataFrame, text_col: str, model_name: str, encoder_factory, classifier, out: str = "complaint") -> DataFrame:
    """Clean, embed, classify: adds the class as ``out``. Stored vectors are used when they are there."""
    rows = embed(add_cleaned(df, text_col), f"{text_col}_cleaned", model_name, encoder_factory)
    scored = score(rows, classifier, embedding_column(f"{text_col}_cleaned", model_name))
    return scored.select(*df.columns, F.col("prediction").alias(out))


def nae_rule(df: DataFrame, model, out: str = "not_an_experience") -> DataFrame:
    """Bag-of-words pipeline: adds the class as ``out`` and its probability."""
    scored = score(df, model)
    return scored.select(*df.columns, F.col("prediction").alias(out), F.col("probability").alias(f"{out}_probability"))


def safeguarding_rule(df: DataFrame, logits_col: str, out: str = "safeguarding") -> DataFrame:
    """Three-class scores per row to class name, severity 0-2 and probability of the winning class."""
    names = {number: name for name, number in SEVERITY.items()}
    rows = df.withColumn("_top", top_class(logits_col))
    name = lookup(F.col("_top.class"), names)
    return rows.select(
        *df.columns,
        name.alias(f"{out}_class"),
        severity(name).alias(out),
        F.col("_top.probability").alias(f"{out}_probability"),
    )


def uninformative_rule(df: DataFrame, vector_col: str, classifier, out: str = "uninformative") -> DataFrame:
    """Stored embedding to class and probability, row by row."""
    scored = score(df, classifier, vector_col)
    return scored.select(*df.columns, F.col("prediction").alias(out), F.col("probability").alias(f"{out}_probability"))


def mistakes(df: DataFrame, y: str, p: str, score_col: str, text_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Wrong predictions as ``(mistake, score, text)``: False Pos or False Neg."""
    kind = F.when((F.col(p) == 1) & (F.col(y) == 0), "False Pos").when((F.col(p) == 0) & (F.col(y) == 1), "False Neg")
    return df.select(*keep, kind.alias("mistake"), F.col(score_col).alias("score"), F.col(text_col).alias("text")).filter(
        F.col("mistake").isNotNull()
    )


def assess_run(run_log, registry, run_id: str, models_root: str, id_col: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """Score and assess a recorded run again, on the validation rows of the datasets it names.

    Reads the run's attributes (dataset lists, label and vector columns, model name, ``balance_val``),
    leaves out rows without a vector, predicts, optionally balances afterwards, and returns the binary metrics.
    """
    run = run_log.attributes(run_id)

    def listed(name: str) -> list[str]:
        return [s.strip() for s in run.get(name, "").split(";") if s.strip()]

    names = [
        n
        for group in ("positive_label_dataset_name_list", "negative_label_dataset_name_list", "augmented_dataset_name_list")
        for n in listed(group)
    ]
    y = run["name_of_y_column"]
    vector_col = embedding_column(run["name_of_column_to_embed"], run["model_for_embeddings_name"])
    data = concat_datasets([registry.read_dataset(n) for n in names]).filter((F.col("val") == 1) & F.col(vector_col).isNotNull())
    model = load_model(f"{models_root.rstrip('/')}/{run['model name']}")
    scored = score(data, model, vector_col)
    if run.get("balance_val", "False") == "True":
        scored = balance(scored, y, id_col, seed)
    return M.binary_metrics(scored, y, "prediction")
