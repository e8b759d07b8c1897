"""Training from trips to a saved, logged model."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators import registry, search
from kerbside.operators import train as models
from kerbside.operators.cells import collapse, edges, uncollapsed
from kerbside.operators.encode import ZONES_DISTANCE, FeatureSpec, fit_encoder
from kerbside.operators.prepare import drop_outliers, with_duration, with_month_split
from kerbside.sources.trips import following_month, read_months


def feature_cells(trips: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Split trips to cells, kept for the fits that follow (recomputed if an executor is lost). Numbers are
    binned by the quantiles of all trips, as many trips may have as many distances."""
    kept = drop_outliers(trips)
    return collapse(kept, spec, binned=edges(kept, spec)).persist(StorageLevel.MEMORY_AND_DISK)


def training_rows(trips: DataFrame, spec: FeatureSpec, model_type: str) -> DataFrame:
    """What a model is fitted on.

    Least squares needs numbers only through sums per category, which tasks combine before they
    send anything; cells of every distinct number would be a larger shuffle for nothing. So it reads
    the trips themselves when there are numbers, and cells otherwise. Trees always take cells.
    """
    if model_type == "LR" and spec.numerical:
        return uncollapsed(drop_outliers(trips), spec)
    return feature_cells(trips, spec)


def train_and_log(
    spark: SparkSession,
    cells: DataFrame,
    spec: FeatureSpec,
    root: str,
    experiment: str,
    model_type: str = "LR",
    params: Mapping | None = None,
    tags: Mapping[str, str] | None = None,
) -> str:
    """Fit on `train`, measure every split, save the pipeline and append the run. Returns its id."""
    train, val = (cells.filter(F.col("split") == s) for s in ("train", "val"))
    model = models.fit(train, spec, model_type, params, val if model_type == "XGB" else None)
    scores = models.metrics(model, cells)
    scores["rmse"] = scores.get("val_rmse", float("nan"))
    run_id = registry.new_run_id()
    models.save(model, models.model_location(run_id, root, experiment=experiment))
    return registry.log_run(
        spark, f"{root}/runs", experiment, model_type, {**model.params, **(params or {})}, scores, tags, run_id
    )


def train_month(
    spark: SparkSession,
    base: str,
    root: str,
    color: str,
    year: int,
    month: int,
    model_type: str = "LR",
    spec: FeatureSpec | None = None,
    experiment: str = "trip-duration",
) -> str:
    """Train on a month, validate on the next one."""
    if model_type not in models.MODEL_TYPES:
        raise ValueError(f"unknown model type {model_type!r}; allowed: {list(models.MODEL_TYPES)}")
    spec = spec or FeatureSpec()
    following = following_month(year, month)
    trips = with_duration(read_months(spark, base, [(color, year, month), (color, *following)]))
    split = F.when((F.col("year") == year) & (F.col("month") == month), "train").otherwise("val")
    cells = training_rows(trips.withColumn("split", split), spec, model_type)
    try:
        return train_and_log(spark, cells, spec, root, experiment, model_type)
    finally:
        cells.unpersist()


def prepare_features(
    spark: SparkSession, base: str, dest: str, color: str, months: list[tuple[int, int]], spec: FeatureSpec
) -> None:
    """Write train, val and test cells of three months, and the encoder fitted on train.

    The cells are the feature sets: small, splittable, and enough for every fit.
    """
    trips = read_months(spark, base, [(color, *m) for m in months])
    trips = with_duration(drop_outliers(with_month_split(trips, *months)))
    collapse(trips, spec).write.mode("overwrite").partitionBy("split").parquet(f"{dest}/features")
    encoder = fit_encoder(load_features(spark, dest).filter("split = 'train'"), spec)
    encoder.write().overwrite().save(f"{dest}/encoder")


def load_features(spark: SparkSession, dest: str) -> DataFrame:
    return spark.read.parquet(f"{dest}/features")


def search_and_register(
    spark: SparkSession,
    cells: DataFrame,
    root: str,
    spec: FeatureSpec = ZONES_DISTANCE,
    n_trials: int = search.TRIALS,
    top_n: int = 5,
    space: Mapping = search.FOREST_SPACE,
) -> DataFrame:
    """Search forests, train the best again on record, and name champion and challenger.

    The names are also written to the alias table, as aliases of the model `best`, so `load_by_alias`
    finds the champion afterwards.
    """
    runs = f"{root}/runs"
    objective = search.forest_objective(cells, spec)
    for params, loss in search.search(objective, search.trials(spark, space, n_trials)):
        registry.log_run(spark, runs, "search", "RF", params, {"rmse": loss})
    best = registry.top_runs(registry.read_runs(spark, runs), "search", top_n)
    for params in [r["params"] for r in best.select("params").collect()]:
        typed = {k: int(v) for k, v in params.items() if k in search.FOREST_SPACE}
        train_and_log(spark, cells, spec, root, "best", "RF", typed)
    found = registry.candidates(registry.active_runs(registry.read_runs(spark, runs), "best"))
    now = F.lit(datetime.now(timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")
    registry.set_aliases(found.select(F.lit("best").alias("model"), "alias", "run_id", "validation_status", now.alias("ts")), f"{root}/aliases")
    return found
