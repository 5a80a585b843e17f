"""A search as a ledger: trials are claimed and committed one by one, so a killed driver resumes where it stopped."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions.hashing import DEFAULT_SEED
from reviewloom.operators import metrics as M
from reviewloom.operators.external import embedding_column
from reviewloom.operators.sampling import evaluation_sets
from reviewloom.operators.train import MixSearch, describe, save_model, score
from reviewloom.sources.registry import Registry, create_once
from reviewloom.sources.runlog import MODEL_NAME, SCHEMA, RunLog

TRIAL = "trial int, score double, n_rows bigint, params string, rows string, session int"


class Ledger:
    """Plan, claims and finished trials of one search under a shared folder.

    Whatever counts is written aside and renamed into its place, so it is there as a whole or not at all. A claim is a
    file that only one caller can create. Claims bind within a session; a new session of the ledger takes the claims
    of earlier ones for dead, and drivers that share a search pass each other the session's number.
    """

    def __init__(self, spark: SparkSession, root: str, session: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.session = session or self._next_session()

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), where

    def _created(self, path: str) -> bool:
        return create_once(*self._fs(path))

    def _next_session(self) -> int:
        number = 1
        while not self._created(f"{self.root}/sessions/{number}"):
            number += 1
        return number

    def _placed(self, rows: DataFrame, path: str) -> bool:
        """Write a small frame aside and move it to ``path``; False, and nothing written, if that exists."""
        aside = f"{self.root}/attempts/{uuid.uuid4().hex}"
        rows.coalesce(1).write.parquet(aside)
        fs, target = self._fs(path)
        fs.mkdirs(target.getParent())
        _, source = self._fs(aside)
        moved = not fs.exists(target) and fs.rename(source, target)
        if not moved:
            fs.delete(source, True)
        return moved

    def plan(self, settings: Mapping) -> dict:
        """The settings the search was first opened with. Other settings than those are refused."""
        text = json.dumps(settings, sort_keys=True)
        path = f"{self.root}/plan"
        fs, where = self._fs(path)
        if not fs.exists(where):
            self._placed(self.spark.createDataFrame([(text,)], "settings string"), path)
        first = json.loads(self.spark.read.parquet(path).first()["settings"])
        differs = sorted(k for k in settings if k != "versions" and json.loads(text)[k] != first.get(k))
        if differs:
            raise ValueError(f"this search was begun with other settings: {', '.join(differs)}")
        return first

    def trials(self) -> DataFrame:
        """Finished trials. Should two drivers have run one, the earlier session's line counts; both say the same."""
        fs, where = self._fs(f"{self.root}/trials")
        if not fs.exists(where):
            return self.spark.createDataFrame([], TRIAL)
        lines = self.spark.read.schema(TRIAL).option("recursiveFileLookup", "true").parquet(f"{self.root}/trials")
        first = F.min_by(F.struct(*(c for c in lines.columns if c != "trial")), "session")
        return lines.groupBy("trial").agg(first.alias("line")).select("trial", "line.*")

    def pending(self, trials: int) -> list[int]:
        """Planned trials that are not finished: the plan without what the ledger holds."""
        planned = self.spark.range(trials).select(F.col("id").cast("int").alias("trial"))
        return sorted(r["trial"] for r in planned.join(self.trials(), "trial", "left_anti").collect())

    def claim(self, trial: int) -> bool:
        return self._created(f"{self.root}/claims/{trial}-{self.session}")

    def commit(self, row: Mapping) -> bool:
        """Record a trial; False if it was recorded before."""
        line = (row["trial"], row["score"], row["n_rows"], json.dumps(row["params"], sort_keys=True), json.dumps(row["rows"], sort_keys=True), self.session)
        return self._placed(self.spark.createDataFrame([line], TRIAL), f"{self.root}/trials/{row['trial']}")


def run_trials(ledger: Ledger, search: MixSearch, parallelism: int = 4) -> DataFrame:
    """Run what is pending, each trial once, and give all finished trials."""

    def one(trial: int) -> None:
        if ledger.claim(trial):
            ledger.commit(search.run(trial)[0])

    with ThreadPoolExecutor(parallelism) as threads:
        list(threads.map(one, ledger.pending(search.trials)))
    return ledger.trials()


def _lines(spark: SparkSession, numbers: Mapping[str, float], texts: Mapping[str, object], run_id: str, experiment: str) -> DataFrame:
    """Lines of the run log: numbers as metrics, and settings as text with their number where they are one."""
    rows = [(experiment, run_id, name, None if value is None else float(value), None) for name, value in numbers.items()]
    for name, value in texts.items():
        number = float(value) if isinstance(value, (int, float)) else None
        rows.append((experiment, run_id, name, number, "; ".join(map(str, value)) if isinstance(value, (list, tuple)) else str(value)))
    frame = spark.createDataFrame(rows, "experiment string, run_id string, name string, value double, text string")
    return frame.withColumn("logged_at", F.current_timestamp()).select(*(f.name for f in SCHEMA.fields))


def search_and_record(
    registry: Registry,
    log: RunLog,
    home: str,
    experiment: str,
    positives: Sequence[str],
    negatives: Sequence[str],
    kind: str,
    y: str,
    id_col: str,
    text_col: str,
    embedder: str,
    augmented: Sequence[str] = (),
    trials: int = 20,
    scorer: Callable[[DataFrame, str, str], float | None] | None = None,
    balance_test: bool = True,
    balance_val: bool = True,
    multiclass: bool = False,
    parallelism: int = 4,
    seed: int = DEFAULT_SEED,
    fixed: Mapping | None = None,
    model_name: str | None = None,
) -> str:
    """Search, assess the winner on validation rows, save it and record the run; returns the model's name.

    The ledger lies at ``<home>/searches/<experiment>`` and models at ``<home>/models``. A call that was cut short is
    repeated with the same arguments: finished trials are not run again, the dataset versions are those of the first
    call even if newer ones were registered since, and a run that is in the log already is left as it is. Trials,
    metrics, settings and the model's name reach the log in one append, after the model was saved, so a run is either
    in the log with everything or not in it. Trials are lines of runs ``<experiment>/<trial>``.
    """
    spark, name = registry.spark, model_name or f"{kind} {experiment}"
    names = [*positives, *negatives, *augmented]
    ledger = Ledger(spark, f"{home.rstrip('/')}/searches/{experiment}")
    settings = {
        "positive_label_dataset_name_list": list(positives), "negative_label_dataset_name_list": list(negatives),
        "augmented_dataset_name_list": list(augmented), "name_of_y_column": y, "name_of_column_to_embed": text_col,
        "model_for_embeddings_name": embedder, "classifier_class_name": kind, "max_evals": trials, "balance_test": balance_test,
        "balance_val": balance_val, "multiclass": multiclass, "seed": seed, "fixed": dict(fixed or {}), MODEL_NAME: name,
    }
    plan = ledger.plan({**settings, "versions": {n: registry.latest_version(n) for n in names}})
    if log.exists() and not log.read().where((F.col("run_id") == experiment) & (F.col("name") == MODEL_NAME)).isEmpty():
        return name
    versions = plan["versions"]
    datasets = {n: registry.read_dataset(n, versions[n]) for n in names}
    vector_col = embedding_column(text_col, embedder)
    with MixSearch(datasets, positives, kind, y, id_col, vector_col, trials, scorer, balance_test, multiclass, seed, fixed) as search:
        done = run_trials(ledger, search, parallelism)
        best = done.orderBy(F.col("score").desc_nulls_last(), "trial").first()
        _, model = search.run(best["trial"])  # the same draws, the same model
    save_model(model, f"{home.rstrip('/')}/models/{name}")

    val = evaluation_sets([d.where(F.col(vector_col).isNotNull()) for d in datasets.values()], y, id_col, False, balance_val, seed)["val"]
    scored = score(val, model, vector_col)
    judge = search.scorer(scored, y, "prediction")
    numbers = {"validation score": judge, "test score": best["score"]}
    if not multiclass:
        numbers |= M.binary_metrics(scored, y, "prediction").first().asDict()
    else:
        numbers |= {n: M.scorer(n)(scored, y, "prediction") for n in ("f1_macro", "f1_micro", "recall_macro", "accuracy")}
    won = {**json.loads(best["params"]), **{f"rows of {s}": n for s, n in json.loads(best["rows"]).items()}}
    texts = {**{k: v for k, v in settings.items() if k != "fixed"}, **won, **{f"{n}_version": v for n, v in versions.items()}}
    texts["description"] = describe({k: str(v) for k, v in settings.items()})
    lines = _lines(spark, numbers, texts, experiment, experiment)
    tried = done.select(
        F.lit(experiment).alias("experiment"), F.concat(F.lit(f"{experiment}/"), F.col("trial").cast("string")).alias("run_id"),
        F.expr("stack(2, 'score', score, 'n_rows', cast(n_rows as double)) as (name, value)"),
    ).select("*", F.lit(None).cast("string").alias("text"), F.current_timestamp().alias("logged_at"))
    log.append(lines.unionByName(tried))
    return name
