"""Run log: one line per run and metric or attribute, appended as Parquet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("experiment", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("text", T.StringType()),
        T.StructField("logged_at", T.TimestampType()),
    ]
)

MODEL_NAME = "model name"


class RunLog:
    """Metrics and attributes of runs under one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def exists(self) -> bool:
        """Has anything been logged yet?"""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return where.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(where)

    def append(self, lines: DataFrame) -> None:
        """Append lines of the log's schema in one job: all of them, or none if it fails."""
        lines.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMA.fields]).write.mode("append").parquet(self.path)

    def log_run(self, metrics: DataFrame, run_id: str, experiment: str = "") -> None:
        """Append ``(name, value)`` lines. Only numbers are metrics: anything else raises TypeError."""
        value_type = metrics.schema["value"].dataType
        if not isinstance(value_type, T.NumericType):
            raise TypeError(f"metric values must be numbers, got {value_type.simpleString()}")
        self.append(
            metrics.select(
                F.lit(experiment).alias("experiment"),
                F.lit(run_id).alias("run_id"),
                "name",
                F.col("value").cast("double"),
                F.lit(None).cast("string").alias("text"),
                F.current_timestamp().alias("logged_at"),
            )
        )

    def log_attributes(self, attributes: Mapping, run_id: str, experiment: str = "", logged_at: datetime | None = None) -> None:
        """Append settings of a run; lists are joined by ``; ``."""
        rows = []
        for name, value in attributes.items():
            number = float(value) if isinstance(value, (int, float)) else None
            text = "; ".join(map(str, value)) if isinstance(value, (list, tuple)) else str(value)
            rows.append((experiment, run_id, str(name), number, text))
        frame = self.spark.createDataFrame(rows, T.StructType(SCHEMA.fields[:-1]))
        when = F.lit(logged_at) if logged_at else F.current_timestamp()
        self.append(frame.withColumn("logged_at", when))

    def log_dataset_versions(self, registry, names: Sequence[str], run_id: str, experiment: str = "") -> None:
        """Record which version of each dataset fed a run."""
        self.log_attributes({f"{n}_version": registry.latest_version(n) for n in names}, run_id, experiment)

    def attributes(self, run_id: str) -> dict[str, str]:
        """Attributes of one run."""
        rows = self.read().filter((F.col("run_id") == run_id) & F.col("text").isNotNull()).select("name", "text")
        return {r["name"]: r["text"] for r in rows.collect()}


def leaderboard(runs: DataFrame, metric: str) -> DataFrame:
    """Best run per experiment by a metric; the smaller run id wins a tie."""
    lines = runs.filter((F.col("name") == metric) & F.col("value").isNotNull())
    # The smallest (-value, run_id) is the best value with its smallest run id; it combines on the map side.
    return (
        lines.groupBy("experiment")
        .agg(F.min(F.struct((-F.col("value")).alias("v"), F.col("run_id"))).alias("_best"))
        .select("experiment", F.col("_best.run_id").alias("run_id"), (-F.col("_best.v")).alias("value"))
    )


def list_models(runs: DataFrame) -> DataFrame:
    """Saved models, newest first."""
    return (
        runs.filter(F.col("name") == MODEL_NAME)
        .groupBy(F.col("text").alias("model"))
        .agg(F.max("logged_at").alias("created"), F.max_by("run_id", "logged_at").alias("run_id"))
        .orderBy(F.col("created").desc(), "model")
    )


def find_run(runs: DataFrame, run_id: str | None = None, experiment: str | None = None) -> DataFrame:
    """Lines of the log for a run, or for all runs of an experiment."""
    wanted: Column = F.lit(True)
    if run_id is not None:
        wanted = wanted & (F.col("run_id") == run_id)
    if experiment is not None:
        wanted = wanted & (F.col("experiment") == experiment)
    return runs.filter(wanted)
