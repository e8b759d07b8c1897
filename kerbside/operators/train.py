"""Fit, evaluate, save and load duration models."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce
from operator import and_

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.columns import zone_number
from kerbside.operators import cells as cell
from kerbside.operators import grow, linear, trees
from kerbside.operators.encode import PAIR, FeatureSpec, fit_encoder, labels
from kerbside.session import ensure_checkpoint_dir

# The accepted model types and the parameters the models are trained with unless
# told otherwise.
MODEL_TYPES = ("LR", "RF", "XGB")
FOREST = {"max_depth": 10, "n_estimators": 100, "min_samples_leaf": 1, "min_samples_split": 2, "bootstrap": True, "random_state": 42}
BOOSTED = {
    "learning_rate": 0.09585355369315604,
    "max_depth": 30,
    "min_child_weight": 1.060597050922164,
    "num_boost_round": 30,
    "early_stopping_rounds": 50,
    "seed": 42,
}
# Taken and logged, but without a counterpart in Spark's trees.
WITHOUT_EFFECT = ("reg_alpha", "reg_lambda", "objective", "n_jobs")
# Identification that a search hands on with its parameters.
LABELS = ("trial",)

# Rows that trees are fitted on, at least: heavy cells are split so that bagging draws trips, not cells.
TREE_ROWS = 4096
# Rows in a partition of them: a task a core where it has the former, and more tasks beyond the latter.
PART_ROWS, MAX_PART_ROWS = 4096, 500_000
# Forests that may have more leaves than the default one are grown by `operators.grow`: Spark's fit takes milliseconds
# for every node.
SPARK_LEAVES = FOREST["n_estimators"] * 2 ** FOREST["max_depth"]
# Boosting that may have more levels in all its rounds is grown there, too: Spark's fit takes two jobs for each.
SPARK_LEVELS = 10 * BOOSTED["num_boost_round"]


@dataclass
class Trained:
    """A fitted model: effects for least squares, else a pipeline with the features included."""

    pipeline: PipelineModel | linear.LinearEffects
    spec: FeatureSpec
    model_type: str
    params: dict = field(default_factory=dict)

    @property
    def regressor(self):
        return self.pipeline.stages[-1]

    @property
    def intercept(self) -> float:
        return self.pipeline.intercept


def fit(
    train: DataFrame,
    spec: FeatureSpec,
    model_type: str = "LR",
    params: Mapping | None = None,
    validation: DataFrame | None = None,
    ready: tuple | None = None,
) -> Trained:
    """Fit a model on cells (see `operators.cells`); `validation` cells stop boosting early. A forest takes what
    `prepared` gave for these cells, if there is any."""
    if model_type not in MODEL_TYPES:
        raise ValueError(f"unknown model type {model_type!r}; allowed: {list(MODEL_TYPES)}")
    known = {"LR": {}, "RF": FOREST, "XGB": BOOSTED}[model_type]
    given = dict(params or {})
    if unknown := sorted(set(given) - set(known) - set(WITHOUT_EFFECT) - set(LABELS)):
        raise ValueError(f"unknown parameters of {model_type}: {unknown}; known: {sorted(known)}, without effect: {sorted(WITHOUT_EFFECT)}")
    if model_type == "LR":
        pipeline = linear.fit(train, spec)
        used = {"columns": sum(pipeline.sizes.values()) + len(pipeline.numbers), **given}
    elif model_type == "RF":
        pipeline, used = _forest(train, spec, {**FOREST, **given}, ready)
    else:
        pipeline, used = _boosted(train, spec, {**BOOSTED, **given}, validation)
    if idle := sorted(set(given) & set(WITHOUT_EFFECT)):
        used["without_effect"] = ",".join(idle)
    if model_type != "LR" and PAIR in spec.categorical:
        used["pair_as"] = "two zones"  # an unseen pair of known zones is answered as what its zones say
    return Trained(pipeline, spec, model_type, used)


def _tree_spec(spec: FeatureSpec) -> FeatureSpec:
    """Trees take the two zones of a pair as two categories: two splits isolate any pair, while a
    column per pair would be stored densely for every row."""
    if PAIR not in spec.categorical:
        return spec
    zones = tuple(c for c in spec.categorical if c != PAIR) + ("PULocationID", "DOLocationID")
    return FeatureSpec(tuple(dict.fromkeys(zones)), spec.numerical)


def _tree_encoder(train: DataFrame, spec: FeatureSpec):
    """Indexed categories (one column per zone feature, however many zones) and their bin count."""
    encoder = fit_encoder(train, _tree_spec(spec), one_hot=False)
    return encoder, max([32] + [len(x) + 1 for x in labels(encoder)])


def _tree_rows(train: DataFrame, encoder: PipelineModel, bins: int) -> tuple[DataFrame, float]:
    """Cells as rows for trees, and the weight of all trips.

    A cell is split into parts of equal weight, as many as its share of the trips is worth out of
    `TREE_ROWS` (or two for each bin, if that is more). Sums stay as they are, so splits do, too; but
    bagging now leaves out a part of a heavy cell, as it leaves out some of its trips, and a
    feature never has more categories than there are rows.

    For every level of its trees a fit sends the bins of all open nodes from each partition, full or not. So
    there are as many partitions as cores can work on, and not as many as the shuffle of the cells had. They are
    a checkpoint, as every task of a fit is sent the plan behind its rows.
    """
    cells, trips = train.agg(F.count(F.lit(1)), F.sum(cell.WEIGHT)).first()
    about = max(TREE_ROWS, 2 * bins, 2 * cells)
    quota = (trips or 1.0) / about
    cores = train.sparkSession.sparkContext.defaultParallelism
    partitions = max(1, min(cores, about // PART_ROWS), math.ceil(about / MAX_PART_ROWS))
    parts = F.ceil(F.col(cell.WEIGHT) / F.lit(quota))
    share = F.explode(F.sequence(F.lit(1).cast("long"), F.greatest(parts, F.lit(1).cast("long")))).alias("part")
    rows = train.select("*", parts.alias("parts"), share).withColumn(cell.WEIGHT, F.col(cell.WEIGHT) / F.col("parts"))
    encoded = encoder.transform(rows.drop("parts")).select("features", cell.LABEL, cell.WEIGHT, "part").coalesce(partitions)
    ensure_checkpoint_dir(train.sparkSession)
    return encoded.checkpoint(), trips


def _arity(spec: FeatureSpec, encoder: PipelineModel) -> list[int]:
    """The categories of each feature of the encoded rows, 0 for a number."""
    categories = {f"{c}=": len(x) + 1 for c, x in zip(_tree_spec(spec).categorical, labels(encoder))}
    return [n for _, n in sorted((categories | dict.fromkeys(spec.numerical, 0)).items())]


def _leaf_size(least: float, trips: float, depth: int) -> dict:
    """A leaf's size counts trips, not cells. Where a leaf must hold half of them nothing can be split."""
    share = least / trips
    return {"minWeightFractionPerNode": share, "maxDepth": depth} if share < 0.5 else {"maxDepth": 0}


def prepared(train: DataFrame, spec: FeatureSpec) -> tuple[PipelineModel, int, DataFrame, float]:
    """Encoder, bins, rows and weight of all trips, that forests on the same cells can share."""
    encoder, bins = _tree_encoder(train, spec)
    return encoder, bins, *_tree_rows(train, encoder, bins)


def _forest(train: DataFrame, spec: FeatureSpec, params: dict, ready: tuple | None = None):
    encoder, bins, encoded, trips = ready or prepared(train, spec)
    least, leaf, size = int(params["min_samples_split"]), int(params["min_samples_leaf"]), int(params["n_estimators"])
    limits = _leaf_size(leaf, trips, int(params["max_depth"]))
    many = size * min(2 ** limits["maxDepth"], (trips or 1.0) / max(1, leaf)) > SPARK_LEAVES
    bagging = {"seed": int(params["random_state"]), "bootstrap": bool(params["bootstrap"])}
    forest = RandomForestRegressor(
        labelCol=cell.LABEL, weightCol=cell.WEIGHT, numTrees=size, featureSubsetStrategy="all", maxBins=bins, **bagging, **limits
    )
    if many and limits["maxDepth"] <= 30:  # deeper ones Spark refuses
        arity = _arity(spec, encoder)
        nodes = grow.grown(encoded, arity, bins, size, limits["maxDepth"], leaf, least, **bagging)
        roots = forest.copy({forest.maxDepth: 0}).fit(encoded)
        return PipelineModel([*encoder.stages, trees.regrown(roots, grow.saved(nodes, arity), limits)]), params
    model = forest.fit(encoded)
    # A node that can be split has two trips anyway.
    return PipelineModel([*encoder.stages, trees.pruned(model, least) if least > 2 else model]), params


def _boosted(train: DataFrame, spec: FeatureSpec, params: dict, validation: DataFrame | None):
    """All rounds are fitted. With validation cells, and a patience shorter than the rounds, the model is
    cut at the best round before the first one that `early_stopping_rounds` others did not improve."""
    if int(params["max_depth"]) > 30:
        raise ValueError("boosted trees take a depth of 30 at most")
    encoder, bins = _tree_encoder(train, spec)
    ensure_checkpoint_dir(train.sparkSession)
    encoded, trips = _tree_rows(train, encoder, bins)
    rounds, patience = int(params["num_boost_round"]), int(params["early_stopping_rounds"])
    step, leaf = float(params["learning_rate"]), float(params["min_child_weight"])
    limits = _leaf_size(leaf, trips, int(params["max_depth"]))
    boosting = GBTRegressor(
        labelCol=cell.LABEL,
        weightCol=cell.WEIGHT,
        maxIter=rounds,
        stepSize=step,
        maxBins=bins,
        seed=int(params["seed"]),
        checkpointInterval=1,  # else every task is sent the trees since the last one
        **limits,
    )
    if rounds * limits["maxDepth"] > SPARK_LEVELS:
        arity = _arity(spec, encoder)
        nodes = grow.boosted(encoded, arity, bins, rounds, step, limits["maxDepth"], leaf)
        roots = boosting.copy({boosting.maxDepth: 0, boosting.maxIter: min(rounds, 2)}).fit(encoded)
        model = trees.reboosted(roots, grow.saved(nodes, arity), rounds, limits)
    else:
        model = boosting.fit(encoded)
    if validation is not None and patience < rounds:
        held_out = encoder.transform(validation).select("features", cell.LABEL, cell.WEIGHT)
        if kept := _best_round(model.evaluateEachIteration(held_out, "squared"), patience):
            model = trees.shortened(model, kept)
    return PipelineModel([*encoder.stages, model]), params


def _best_round(losses: Sequence[float], patience: int) -> int | None:
    """The number of rounds to keep, or none if the patience never ran out."""
    best = 0
    for k, loss in enumerate(losses):
        if loss < losses[best]:
            best = k
        elif k - best >= patience:
            return best + 1
    return None


def predict(model: Transformer | Trained, rides: DataFrame) -> DataFrame:
    """Append `prediction`. Linear models add effects, all others run the pipeline."""
    if isinstance(model, Trained) and isinstance(model.pipeline, linear.LinearEffects):
        return model.pipeline.predict(rides)
    return predict_vectors(model, rides)


def predict_vectors(model: Transformer | Trained, rides: DataFrame) -> DataFrame:
    """Append `prediction` by running the pipeline; the encoder's working columns are dropped again."""
    pipeline = model.pipeline if isinstance(model, Trained) else model
    return pipeline.transform(rides).select(*rides.columns, "prediction")


def predict_combinations(model: Transformer | Trained, rides: DataFrame, spec: FeatureSpec) -> DataFrame:
    """`predict` for costly models (many trees): score every combination of inputs once.

    Rides repeat their inputs, so far fewer rows pass the model; the answers are joined back by
    input. With zones only there are at most zones squared, which Spark broadcasts; more are joined
    by key, with the partitions of frequent combinations split.
    """
    keyed = {c: F.col(c) if c in spec.numerical else zone_number(c) for c in spec.inputs}
    combinations = rides.select(*[v.alias(c) for c, v in keyed.items()]).distinct()
    answers = predict(model, combinations).select(*[F.col(c).alias(f"_{c}") for c in keyed], "prediction")
    same = reduce(and_, [v.eqNullSafe(F.col(f"_{c}")) for c, v in keyed.items()])
    return rides.join(answers, same, "left").select(*[F.col(c) for c in rides.columns], "prediction")


def constant_model(value: float) -> PipelineModel:
    """A model that always answers `value`, for tests and dry runs."""
    return PipelineModel([SQLTransformer(statement=f"SELECT *, CAST({value!r} AS DOUBLE) AS prediction FROM __THIS__")])


def evaluate(model: Trained | PipelineModel, data: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    """RMSE per split, in one pass over the cells of all splits."""
    return predict(model, data).groupBy(*by).agg(F.sum(cell.WEIGHT).cast("bigint").alias("n"), cell.rmse().alias("rmse"))


def metrics(model: Trained | PipelineModel, data: DataFrame) -> dict[str, float]:
    """`{split}_rmse` per split present in the cells."""
    return {f"{r['split']}_rmse": r["rmse"] for r in evaluate(model, data).collect()}


def row_rmse(scored: DataFrame, label: str = "duration", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """RMSE over single rows."""
    return scored.groupBy(*by).agg(F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), 2))).alias("rmse"))


def save(model: Trained, path: str) -> None:
    """Effects, or encoder and model as one pipeline, next to the feature set and parameters."""
    spark = SparkSession.active()
    if isinstance(model.pipeline, linear.LinearEffects):
        model.pipeline.save(path)
    else:
        model.pipeline.write().overwrite().save(f"{path}/pipeline")
    about = {"spec": asdict(model.spec), "model_type": model.model_type, "params": model.params}
    spark.createDataFrame([(json.dumps(about),)], "value STRING").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load(spark: SparkSession, path: str) -> Trained:
    about = json.loads(spark.read.text(f"{path}/about").first()["value"])
    spec = FeatureSpec(tuple(about["spec"]["categorical"]), tuple(about["spec"]["numerical"]))
    fitted = linear.LinearEffects.load(spark, path) if about["model_type"] == "LR" else PipelineModel.load(f"{path}/pipeline")
    return Trained(fitted, spec, about["model_type"], about["params"])


def model_location(run_id: str, root: str, location: str | None = None, experiment: str = "1") -> str:
    """An explicit location wins; else `<root>/<experiment>/<run_id>`."""
    return location or f"{root.rstrip('/')}/{experiment}/{run_id}"
