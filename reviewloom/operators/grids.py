"""Parameter grids, prompts, experiment lists and search spaces."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions.hashing import DEFAULT_SEED, uniform
from reviewloom.functions.text import fill_template
from reviewloom.operators.sampling import sample_n

# Value lists for review prompts.
SENTIMENTS = ["very negative", "slightly negative", "neutral", "slightly positive", "very positive"]

# The complaints grid (7 x 6 x 4 x 5 values, repeats weight the draw).
COMPLAINTS_GRID = {
    "location": [
        "GP Practice",
        "dental practice",
        "hospital",
        "sexual health clinic",
        "optician",
        "pharmacy",
        "hospital department",
    ],
    "topic": [
        "case of criminality by a member of staff",
        "formal complaint being raised, or intent to do so",
        "racist, homophobic, mysoginist or ableist behaviour by a member of staff",
        "medical negligence by a member of staff",
        "violent behaviour by a member of staff",
        "overcharging patients, or not being transparent about (and or charging) excessive fees",
    ],
    "sentiment": ["very negative", "slightly negative", "negative", "neutral"],
    "word_count": ["100", "200", "300", "200", "250"],
}

# The not-an-experience grid (7 x 7 x 4 x 6 values).
NOT_EXPERIENCE_GRID = {
    "location": [
        "GP Practice",
        "dental practice",
        "hospital",
        "sexual health clinic",
        "optician",
        "pharmacy",
        "hospital department",
    ],
    "sentiment": [
        "negative",
        "slightly negative",
        "neutral",
        "neutral",
        "neutral",
        "slightly positive",
        "positive",
    ],
    "tense": ["present", "present", "present", "past"],
    "word_count": ["30", "30", "40", "50", "100", "150"],
}


def expand_grid(df: DataFrame, grid: Mapping[str, Sequence], position: str | None = "grid_pos") -> DataFrame:
    """Every row once per combination of the parameter values; repeated values are kept.

    Each list becomes an exploded literal array, so the expansion stays inside one stage: no join and no
    shuffle. ``position`` numbers the combinations in the order of nested loops, first parameter outermost.
    """
    out = df
    place: Column = F.lit(0)
    for i, (name, values) in enumerate(grid.items()):
        items = F.array(*[F.lit(v) for v in values])
        out = out.select("*", F.posexplode(items).alias(f"_pos{i}", name))
        place = place * F.lit(len(values)) + F.col(f"_pos{i}")
    if position:
        out = out.withColumn(position, place)
    return out.drop(*[f"_pos{i}" for i in range(len(grid))])


def param_grid(spark: SparkSession, grid: Mapping[str, Sequence], position: str = "grid_pos") -> DataFrame:
    """All combinations of parameter values, one row each."""
    return expand_grid(spark.range(1).drop("id"), grid, position)


def prompt_table(
    seeds: DataFrame, grid: Mapping[str, Sequence], template: str, id_col: str, k: int | None = None, seed: int = DEFAULT_SEED
) -> DataFrame:
    """Prompts for every seed row and parameter combination, optionally a seeded draw of k of them.

    Placeholders may name grid parameters and columns of the seed rows. ``prompt_id`` is
    ``<seed id>-<grid position>``.
    """
    rows = expand_grid(seeds, grid, "_pos").withColumn(
        "prompt_id", F.concat_ws("-", F.col(id_col).cast("string"), F.col("_pos").cast("string"))
    )
    rows = rows.drop("_pos")
    if k is not None:
        rows = sample_n(rows, k, "prompt_id", seed)
    return rows.withColumn("prompt", fill_template(template, {c: c for c in rows.columns}))


def read_experiment_list(df: DataFrame, line: str = "value") -> DataFrame:
    """``embedding,classifier[,beta]`` text lines as columns; blank lines are skipped."""
    parts = F.split(F.trim(F.col(line)), ",")
    return df.filter(F.trim(F.col(line)) != "").select(
        F.get(parts, 0).alias("embedding"),
        F.get(parts, 1).alias("classifier"),
        F.get(parts, 2).try_cast("double").alias("beta"),
    )


def pending_runs(plan: DataFrame, done: DataFrame) -> DataFrame:
    """Planned (embedding, classifier, beta) runs that have not been completed; no beta equals no beta."""
    d = done.select("embedding", "classifier", "beta").distinct().alias("d")
    p = plan.alias("p")
    same = (
        (F.col("p.embedding") == F.col("d.embedding"))
        & (F.col("p.classifier") == F.col("d.classifier"))
        & F.col("p.beta").eqNullSafe(F.col("d.beta"))
    )
    return p.join(d, same, "left_anti").select("p.*")


def _linear(low: float, high: float) -> Callable[[Column], Column]:
    return lambda u: F.lit(float(low)) + u * F.lit(float(high - low))


def _log(low: float, high: float) -> Callable[[Column], Column]:
    return lambda u: F.lit(float(low)) * F.pow(F.lit(high / low), u)


def _int(low: int, high: int) -> Callable[[Column], Column]:
    return lambda u: F.lit(low) + F.floor(u * F.lit(float(high - low + 1))).cast("int")


def _log_int(low: int, high: int) -> Callable[[Column], Column]:
    return lambda u: F.least(F.floor(F.lit(float(low)) * F.pow(F.lit((high + 1) / low), u)), F.lit(high)).cast("int")


def _choice(values: Sequence[str]) -> Callable[[Column], Column]:
    return lambda u: F.get(F.array(*[F.lit(v) for v in values]), F.floor(u * F.lit(float(len(values)))).cast("int"))


# Ranges of the classifier parameters, as far as Spark ML can fit them, so that what a trial reports is
# what was fitted: trees stop at depth 30 and leaves below half of the rows. Trees
# have no split share and no L1 or L2 penalty here. The solver is drawn for the record: all of them seek one optimum.
SEARCH_SPACES: dict[str, dict[str, Callable[[Column], Column]]] = {
    "SVM": {"C": _log(0.0001, 1), "gamma": _log(1e-5, 1e-1)},
    "random_forest": {
        "n_estimators": _int(100, 1000),
        "max_depth": _int(1, 30),
        "min_samples_leaf": _linear(0.1, 0.499),
    },
    "logistic_regression": {
        "C": _log(0.0001, 1e3),
        "solver": _choice(["newton-cg", "lbfgs", "liblinear", "sag", "saga"]),
        "max_iter": _log_int(100, 1000),
    },
    "xgboost": {
        "n_estimators": _int(100, 1000),
        "max_depth": _int(1, 20),
        "learning_rate": _linear(0.001, 0.3),
        "min_child_weight": _int(1, 10),
        "subsample": _linear(0.5, 1.0),
        "colsample_bytree": _linear(0.5, 1.0),
    },
}


def search_space(trials: DataFrame, trial_col: str, kind: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """Seeded parameter draws of one classifier, one column per parameter, for every trial row."""
    if kind not in SEARCH_SPACES:
        raise ValueError(f"unknown classifier: {kind}")
    draws = {name: draw(uniform(seed, F.lit(name), trial_col)) for name, draw in SEARCH_SPACES[kind].items()}
    return trials.withColumns(draws)


def trial_samples(sizes: DataFrame, source: str, size: str, trials: int, seed: int = DEFAULT_SEED) -> DataFrame:
    """Rows to take from each source in each trial: a seeded draw from 1 to the size of the source."""
    every = sizes.withColumn("trial", F.explode(F.sequence(F.lit(0), F.lit(trials - 1))))
    draw = uniform(seed, F.lit("rows"), source, "trial")
    return every.withColumn("n_rows", F.lit(1) + F.floor(draw * F.col(size)))
