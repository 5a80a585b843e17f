"""Classifiers: bag of words, training by name, grid search and the joint search over training mixes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from threading import Lock

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import CountVectorizerModel, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.hashing import DEFAULT_SEED, seed_hash, uniform
from reviewloom.operators import metrics as M
from reviewloom.operators.grids import search_space, trial_samples
from reviewloom.operators.kernel import FourierFeatures
from reviewloom.operators.sampling import evaluation_sets
from reviewloom.operators.tables import concat_datasets
from reviewloom.operators.terms import vocabulary
from reviewloom.plans.hash_rank import HashCounts

FEATURES = "_features"
LABEL = "_label"
WAVES = "_waves"

#: Random features of a Gaussian kernel.
KERNEL_FEATURES = 512

# Size of the bag of words, number of folds, grid of the regularisation strengths.
VOCABULARY_SIZE = 10_000
FOLDS = 5
GRID_C = (0.001, 0.01, 0.1, 1, 10, 100)
GRID_PENALTIES = ("l1", "l2")

# When the iterative classifiers stop.
TOLERANCE = {"SVM": 1e-3, "logistic_regression": 1e-4}

TERM_PATTERN = r"[\p{L}\p{N}_]{2,}"


def with_features(df: DataFrame, vector_col: str, y: str | None = None) -> DataFrame:
    """Vectors stay arrays everywhere else; this is the one place where they become ML vectors.

    For training (with ``y``) rows without a vector or a label are left out.
    """
    if y:
        df = df.filter(F.col(vector_col).isNotNull() & F.col(y).isNotNull())
    out = df.withColumn(FEATURES, array_to_vector(F.col(vector_col)))
    return out.withColumn(LABEL, F.col(y).cast("double")) if y else out


def _n_features(model) -> int:
    """Length of the vectors that a fitted classifier takes."""
    stages = model.stages if isinstance(model, PipelineModel) else [model]
    taker = next((s for s in stages if isinstance(s, FourierFeatures)), stages[-1])
    return getattr(taker, "models", [taker])[0].numFeatures


def bow(df: DataFrame, text_col: str, size: int = VOCABULARY_SIZE) -> PipelineModel:
    """Bag of words over the most frequent terms of two or more word characters, stop-words kept.

    The vocabulary is a top-k report of term counts, with ties in alphabetical order, so that the same
    texts always give the same columns.
    """
    terms = [r["term"] for r in vocabulary(df, text_col, size, TERM_PATTERN).select("term").collect()]
    tokenizer = RegexTokenizer(
        inputCol=text_col, outputCol="_terms", pattern=TERM_PATTERN, gaps=False, toLowercase=True
    )
    counter = CountVectorizerModel.from_vocabulary(terms or [""], inputCol="_terms", outputCol=FEATURES)
    return PipelineModel(stages=[tokenizer, counter])


def _per_row_strength(params: Mapping, n: int) -> float:
    """Inverse regularisation strength C as Spark's per-row penalty."""
    return 1.0 / (float(params.get("C", 1.0)) * max(n, 1))


def _within(params: Mapping, name: str, default, low, high):
    """A parameter that must lie where Spark can fit it; nothing is clipped in silence."""
    value = params.get(name, default)
    if not low <= value <= high:
        raise ValueError(f"{name} must be between {low} and {high}, got {value}")
    return value


def estimator(kind: str, params: Mapping, n_rows: int, n_classes: int = 2, dims: int | None = None):
    """An unfitted classifier by name. Parameters without a counterpart in Spark ML are ignored.

    A support vector machine with ``gamma`` has a Gaussian kernel of that width, by ``n_features`` random Fourier
    features of the ``dims`` components; without it is linear.
    """
    common = {"featuresCol": FEATURES, "labelCol": LABEL}
    if kind == "SVM":
        kernel = params.get("gamma") is not None
        columns = {**common, "featuresCol": WAVES} if kernel else common
        base = LinearSVC(
            regParam=_per_row_strength(params, n_rows),
            standardization=False,
            maxIter=int(params.get("max_iter", 100)),
            tol=TOLERANCE["SVM"],
            **columns,
        )
        last = base if n_classes <= 2 else OneVsRest(classifier=base, **columns)
        if not kernel:
            return last
        waves = FourierFeatures(
            inputCol=FEATURES, outputCol=WAVES, gamma=float(params["gamma"]), size=int(params.get("n_features", KERNEL_FEATURES)), dims=dims, seed=DEFAULT_SEED
        )
        return Pipeline(stages=[waves, last])
    if kind == "logistic_regression":
        return LogisticRegression(
            regParam=_per_row_strength(params, n_rows),
            elasticNetParam={"l1": 1.0, "l2": 0.0}[params.get("penalty", "l2")],
            standardization=False,
            maxIter=int(params.get("max_iter", 100)),
            tol=TOLERANCE["logistic_regression"],
            **common,
        )
    if kind == "random_forest":
        return RandomForestClassifier(
            numTrees=int(params.get("n_estimators", 100)),
            maxDepth=int(_within(params, "max_depth", 10, 0, 30)),
            minWeightFractionPerNode=float(_within(params, "min_samples_leaf", 0.0, 0.0, 0.4999)),
            seed=DEFAULT_SEED,
            **common,
        )
    if kind == "xgboost":
        base = GBTClassifier(
            maxIter=int(params.get("n_estimators", 100)),
            maxDepth=int(_within(params, "max_depth", 6, 0, 30)),
            stepSize=float(params.get("learning_rate", 0.1)),
            minInstancesPerNode=int(params.get("min_child_weight", 1)),
            subsamplingRate=float(params.get("subsample", 1.0)),
            featureSubsetStrategy=str(params.get("colsample_bytree", "all")),
            seed=DEFAULT_SEED,
            **common,
        )
        return base if n_classes <= 2 else OneVsRest(classifier=base, **common)
    raise ValueError(f"unknown classifier: {kind}")


def _without_summary(model):
    """Drop a fitted model's training summary.

    The summary holds the session, and a session in which any query used ``observe`` cannot be sent to
    executors together with the model.
    """
    for part in [model, *getattr(model, "models", []), *(p for stage in getattr(model, "stages", []) for p in [stage, *getattr(stage, "models", [])])]:
        if getattr(part, "hasSummary", False):
            nothing = SparkContext._active_spark_context._jvm.scala.Option.empty()
            part._java_obj.setSummary(nothing)
    return model


def train(df: DataFrame, kind: str, params: Mapping | None = None, n_rows: int | None = None, n_classes: int = 2, cached: bool = False):
    """Fit a classifier by name on ``_features`` and ``_label``; ``cached`` says that ``df`` reads a cached frame."""
    rows = df.select(FEATURES, LABEL)
    held = cached or rows.storageLevel.useMemory or df.storageLevel.useMemory
    if not held:
        rows = rows.persist()  # vectors may come from a costly encoder, and training passes over them often
    try:
        n = rows.count() if n_rows is None else n_rows
        # Only a kernel needs to know the length of a vector beforehand.
        first = rows.first() if kind == "SVM" and (params or {}).get("gamma") is not None else None
        return _without_summary(estimator(kind, params or {}, n, n_classes, first and first[FEATURES].size).fit(rows))
    finally:
        if not held:
            rows.unpersist()


def train_text(df: DataFrame, text_col: str, y: str, kind: str = "logistic_regression", params: Mapping | None = None, size: int = VOCABULARY_SIZE) -> PipelineModel:
    """Bag of words plus classifier as one saved-and-loaded-together pipeline."""
    df = df.filter(F.col(text_col).isNotNull() & F.col(y).isNotNull())
    words = bow(df, text_col, size)
    rows = words.transform(df.withColumn(LABEL, F.col(y).cast("double")))
    return PipelineModel(stages=[*words.stages, train(rows, kind, params)])


def score(df: DataFrame, model, vector_col: str | None = None) -> DataFrame:
    """Add ``prediction`` (int) and, where the model has them, ``probability`` of the predicted class and
    ``decision`` (raw score of class 1). A row whose text or vector is null gets nulls."""
    if not vector_col and FEATURES in df.columns:  # made by ``with_features``, without nulls
        return _scored(df, model.transform(df), F.lit(True), None)
    if vector_col:
        given, missing = vector_col, F.array_repeat(F.lit(0.0), _n_features(model)).cast(df.schema[vector_col].dataType)
    else:
        given, missing = model.stages[0].getInputCol(), F.lit("")
    filled = df.withColumn("_given", F.col(given)).withColumn(given, F.coalesce(F.col(given), missing))
    out = model.transform(with_features(filled, vector_col) if vector_col else filled)
    return _scored(df, out, F.col("_given").isNotNull(), given)


def _scored(df: DataFrame, out: DataFrame, present, given: str | None) -> DataFrame:
    """The columns of ``df`` and what the model added, null where its input is not present."""
    added = [F.when(present, F.col("prediction").cast("int")).alias("prediction")]
    if "probability" in out.columns:
        added.append(F.when(present, F.array_max(vector_to_array("probability"))).alias("probability"))
    if "rawPrediction" in out.columns:
        added.append(F.when(present, F.get(vector_to_array("rawPrediction"), F.lit(1))).alias("decision"))
    return out.select(*(F.col("_given").alias(c) if c == given else c for c in df.columns), *added)


def save_model(model, path: str) -> None:
    """Save a pipeline or a single fitted classifier (as a pipeline of one stage)."""
    whole = model if isinstance(model, PipelineModel) else PipelineModel(stages=[model])
    whole.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def describe(attributes: Mapping) -> str:
    """Attributes of a run for a model's description: ``name = value``, a line each, by name."""
    return "\n".join(f"{name} = {attributes[name]}" for name in sorted(attributes))


@dataclass
class GridResult:
    best_model: object
    best_params: dict
    table: list[tuple[str, float, float]] = field(default_factory=list)


def grid_cv(
    df: DataFrame,
    id_col: str,
    penalties: Sequence[str] = GRID_PENALTIES,
    strengths: Sequence[float] = GRID_C,
    folds: int = FOLDS,
    max_iter: int = 1000,
    parallelism: int = 4,
    seed: int = DEFAULT_SEED,
) -> GridResult:
    """Cross-validated accuracy of logistic regression over penalty x strength, refitted on all rows.

    A row's fold comes from its id. Works on ``_features`` and ``_label``.
    """
    fold = F.floor(uniform(seed, F.lit("fold"), id_col) * F.lit(float(folds))).cast("int")
    rows = df.select(FEATURES, LABEL, fold.alias("_fold")).persist()
    try:
        n_fit = max(int(rows.count() * (folds - 1) / folds), 1)
        base = LogisticRegression(
            featuresCol=FEATURES,
            labelCol=LABEL,
            maxIter=max_iter,
            tol=TOLERANCE["logistic_regression"],
            standardization=False,
        )
        grid = ParamGridBuilder()
        grid.addGrid(base.elasticNetParam, [{"l1": 1.0, "l2": 0.0}[p] for p in penalties])
        grid.addGrid(base.regParam, [1.0 / (c * n_fit) for c in strengths])
        maps = grid.build()
        judge = MulticlassClassificationEvaluator(labelCol=LABEL, metricName="accuracy")
        fitted = CrossValidator(
            estimator=base, estimatorParamMaps=maps, evaluator=judge, numFolds=folds, foldCol="_fold", parallelism=parallelism
        ).fit(rows)
    finally:
        rows.unpersist()
    table = [
        ("l1" if m[base.elasticNetParam] == 1.0 else "l2", 1.0 / (m[base.regParam] * n_fit), float(score_))
        for m, score_ in zip(maps, fitted.avgMetrics)
    ]
    top = max(table, key=lambda row: row[2])
    return GridResult(_without_summary(fitted.bestModel), {"penalty": top[0], "C": top[1]}, table)


@dataclass
class SearchResult:
    best_model: object
    best_score: float
    best_params: dict
    trials: list[dict]


class MixSearch:
    """The trials of a joint search over classifier parameters and training mixes, as a context manager.

    Everything a trial draws comes from the seed and its number, so a trial gives the same result whenever and
    wherever it runs. Training and test rows are cached once; a mix is a plain filter of the training rows.
    """

    def __init__(
        self,
        datasets: Mapping[str, DataFrame],
        positives: Sequence[str],
        kind: str,
        y: str,
        id_col: str,
        vector_col: str,
        trials: int = 20,
        scorer: Callable[[DataFrame, str, str], float | None] | None = None,
        balance_test: bool = True,
        multiclass: bool = False,
        seed: int = DEFAULT_SEED,
        fixed: Mapping | None = None,
    ):
        self.datasets, self.positives, self.kind, self.y, self.id_col, self.vector_col = datasets, positives, kind, y, id_col, vector_col
        self.trials, self.balance_test, self.multiclass, self.seed, self.fixed = trials, balance_test, multiclass, seed, fixed
        self.scorer = scorer or M.default_scorer(multiclass)

    def __enter__(self) -> MixSearch:
        y, id_col, seed, trials = self.y, self.id_col, self.seed, self.trials
        spark = next(iter(self.datasets.values())).sparkSession
        pool = concat_datasets(self.datasets, source_col="_source").filter(F.col(self.vector_col).isNotNull())
        hash_col = seed_hash(seed, id_col)
        narrow = pool.filter((F.col("train") == 1) & F.col(y).isNotNull()).select("_source", id_col)
        self.training = (
            with_features(pool.filter((F.col("train") == 1) & F.col(y).isNotNull()), self.vector_col, y)
            .select("_source", F.struct(hash_col.alias("h"), F.col(id_col).alias("k")).alias("_rank"), FEATURES, LABEL)
            .persist()
        )
        test = evaluation_sets([pool], y, id_col, self.balance_test, False, seed)["test"]
        self.test = with_features(test, self.vector_col, y).select(FEATURES, LABEL, y).persist()
        try:
            counts = HashCounts(narrow, "_source", id_col, seed)
            sampled = {s: n for s, n in counts.sizes.items() if s not in self.positives}
            self.n_classes = pool.filter(F.col(y).isNotNull()).select(y).distinct().count() if self.multiclass else 2
            self.drawn: dict[int, dict[str, int]] = {t: {} for t in range(trials)}
            if sampled:
                table = spark.createDataFrame(list(sampled.items()), "source string, size bigint")
                for r in trial_samples(table, "source", "size", trials, seed).limit(trials * len(sampled)).collect():
                    self.drawn[r["trial"]][r["source"]] = r["n_rows"]
            wanted = {s: sorted({self.drawn[t][s] for t in self.drawn}) for s in sampled}
            self.cuts = counts.cuts(wanted)
            settings = search_space(spark.range(trials).withColumnRenamed("id", "trial"), "trial", self.kind, seed)
            self.settings = {r["trial"]: {**r.asDict(), **(self.fixed or {})} for r in settings.limit(trials).collect()}
            self.key_type = pool.schema[id_col].dataType
        except BaseException:
            self.__exit__()
            raise
        return self

    def __exit__(self, *_) -> None:
        self.training.unpersist()
        self.test.unpersist()

    def run(self, t: int) -> tuple[dict, object]:
        """What a trial gave, and its model."""
        taken = F.col("_source").isin(list(self.positives))
        for source, n in self.drawn[t].items():
            h, k = self.cuts[(source, n)]
            upto = F.struct(F.lit(h).alias("h"), F.lit(k).cast(self.key_type).alias("k"))
            taken = taken | ((F.col("_source") == source) & (F.col("_rank") <= upto))
        params = {k: v for k, v in self.settings[t].items() if k != "trial"}
        mixed = self.training.filter(taken)
        n_rows = mixed.count()
        model = train(mixed, self.kind, params, n_rows, self.n_classes, cached=True)
        value = self.scorer(score(self.test, model), self.y, "prediction")
        return {"trial": t, "score": value, "params": params, "rows": self.drawn[t], "n_rows": n_rows}, model


def search_mix(
    datasets: Mapping[str, DataFrame],
    positives: Sequence[str],
    kind: str,
    y: str,
    id_col: str,
    vector_col: str,
    trials: int = 20,
    scorer: Callable[[DataFrame, str, str], float | None] | None = None,
    balance_test: bool = True,
    multiclass: bool = False,
    parallelism: int = 4,
    seed: int = DEFAULT_SEED,
    fixed: Mapping | None = None,
) -> SearchResult:
    """Search classifier parameters together with how many rows to take from each dataset.

    Training rows of the ``positives`` datasets always take part in full. From every other dataset a trial
    takes its first n training rows in hash order, n being drawn between 1 and the dataset's size. A trial
    is fitted on that mix and scored on the test rows; the best one wins. Trials run from a bounded pool of
    driver threads over one cached training frame. ``fixed`` overrides drawn parameters.
    """
    best: list = []
    lock = Lock()

    def run(t: int) -> dict:
        row, model = search.run(t)
        place = (row["score"] if row["score"] is not None else float("-inf"), -t)
        with lock:  # only the best model so far is kept
            if not best or place > best[0]:
                best[:] = [place, model]
        return row

    with MixSearch(datasets, positives, kind, y, id_col, vector_col, trials, scorer, balance_test, multiclass, seed, fixed) as search:
        with ThreadPoolExecutor(parallelism) as threads:
            results = list(threads.map(run, range(trials)))
    won = results[-best[0][1]]
    return SearchResult(best[1], won["score"], {**won["params"], **won["rows"]}, results)


def trials_frame(spark, result: SearchResult) -> DataFrame:
    """Trials of a search as ``(trial, score, n_rows)`` for the run log; ``n_rows`` counts all rows a trial was fitted on."""
    rows = [(r["trial"], r["score"], r["n_rows"]) for r in result.trials]
    return spark.createDataFrame(rows, "trial int, score double, n_rows bigint")
