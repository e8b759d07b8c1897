"""Runs and model aliases as append-only Parquet tables, and the questions asked of them.

One row is one run or one alias change: appends never rewrite, concurrent writers do not clash, and
the current state is the newest row per key.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RUNS = (
    "run_id STRING, experiment STRING, status STRING, model_type STRING, params MAP<STRING,STRING>, "
    "metrics MAP<STRING,DOUBLE>, tags MAP<STRING,STRING>"
)
ALIASES = "model STRING, alias STRING, run_id STRING, validation_status STRING, ts TIMESTAMP_NTZ"

ACTIVE = "active"


def new_run_id() -> str:
    return uuid.uuid4().hex


def log_run(
    spark: SparkSession,
    path: str,
    experiment: str,
    model_type: str,
    params: Mapping | None = None,
    metrics: Mapping[str, float] | None = None,
    tags: Mapping[str, str] | None = None,
    run_id: str | None = None,
    status: str = ACTIVE,
) -> str:
    """Append one run and return its id."""
    run_id = run_id or new_run_id()
    text = {str(k): str(v) for k, v in (params or {}).items()}
    row = (run_id, experiment, status, model_type, text, {k: float(v) for k, v in (metrics or {}).items()}, dict(tags or {}))
    append_runs(spark.createDataFrame([row], RUNS).coalesce(1), path)
    return run_id


def append_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(path)


def active_runs(runs: DataFrame, experiment: str) -> DataFrame:
    return runs.filter((F.col("experiment") == experiment) & (F.col("status") == ACTIVE))


def top_runs(runs: DataFrame, experiment: str, k: int, metric: str = "rmse") -> DataFrame:
    """The k active runs with the smallest metric; ties go by id, runs without it come last."""
    ranked = active_runs(runs, experiment).withColumn("score", F.col("metrics")[metric])
    return ranked.orderBy(F.col("score").asc_nulls_last(), "run_id").limit(k)


def leaderboard(runs: DataFrame, experiment: str, k: int, metric: str = "rmse") -> DataFrame:
    return top_runs(runs, experiment, k, metric).select("run_id", F.round("score", 3).alias(metric))


def run_report(runs: DataFrame) -> DataFrame:
    """All parameters and metrics, one per row."""
    def long(column: str) -> DataFrame:
        entries = runs.select("run_id", F.explode(column).alias("name", "value"))
        return entries.select("run_id", F.lit(column).alias("kind"), "name", F.col("value").cast("string").alias("value"))

    return long("params").unionByName(long("metrics"))


def candidates(runs: DataFrame, metric: str = "test_rmse") -> DataFrame:
    """Best and second run of every experiment as champion and challenger."""
    scored = runs.filter(F.col("status") == ACTIVE).withColumn("score", F.col("metrics")[metric])
    place = F.row_number().over(Window.partitionBy("experiment").orderBy(F.col("score").asc_nulls_last(), "run_id"))
    return (
        scored.withColumn("place", place)
        .filter("place <= 2")
        .select(
            "experiment",
            "run_id",
            "score",
            F.when(F.col("place") == 1, "champion").otherwise("challenger").alias("alias"),
            F.when(F.col("place") == 1, "approved").otherwise("pending").alias("validation_status"),
        )
    )


def set_aliases(aliases: DataFrame, path: str) -> None:
    """Append alias rows (see ALIASES)."""
    aliases.select("model", "alias", "run_id", "validation_status", "ts").write.mode("append").parquet(path)


def set_alias(
    spark: SparkSession, path: str, model: str, alias: str, run_id: str, status: str, ts: datetime | None = None
) -> None:
    ts = ts or datetime.now(timezone.utc).replace(tzinfo=None)
    set_aliases(spark.createDataFrame([(model, alias, run_id, status, ts)], ALIASES).coalesce(1), path)


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ALIASES).parquet(path)


def current_aliases(aliases: DataFrame, models: Sequence[str] = ()) -> DataFrame:
    """The newest row per model and alias; of rows with one time the larger run id."""
    chosen = aliases.filter(F.col("model").isin(*models)) if models else aliases
    newest = F.max_by(F.struct("run_id", "validation_status", "ts"), F.struct("ts", "run_id", "validation_status"))
    return chosen.groupBy("model", "alias").agg(newest.alias("x")).select("model", "alias", "x.*")


def copy_alias(aliases: DataFrame, source: str, source_alias: str, target: str, alias: str, ts: datetime) -> DataFrame:
    """Rows that give `target`@`alias` the run behind `source`@`source_alias` (promotion)."""
    found = current_aliases(aliases, [source]).filter(F.col("alias") == source_alias)
    return found.select(
        F.lit(target).alias("model"),
        F.lit(alias).alias("alias"),
        "run_id",
        "validation_status",
        F.lit(ts).cast("timestamp_ntz").alias("ts"),
    )


def run_by_alias(aliases: DataFrame, model: str, alias: str) -> str:
    row = current_aliases(aliases, [model]).filter(F.col("alias") == alias).first()
    if row is None:
        raise LookupError(f"{model} has no alias {alias!r}")
    return row["run_id"]
