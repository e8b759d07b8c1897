"""One-hot encoding with a vocabulary frozen at training time.

A feature set names its inputs. `PULocationID` and `DOLocationID` are zones, `PU_DO` is the pair of
both, anything else is numeric. The zone clean-up and the pair are stages of the saved pipeline, so
training, batch scoring, requests and streams cannot encode a ride differently.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions.columns import UNKNOWN_ZONE, pair_key, required, zone_code
from kerbside.session import ensure_checkpoint_dir

PAIR = "PU_DO"


@dataclass(frozen=True)
class FeatureSpec:
    categorical: tuple[str, ...] = ("PULocationID", "DOLocationID")
    numerical: tuple[str, ...] = ()

    def __post_init__(self):
        # Features are laid out in name order, as in the vocabulary.
        object.__setattr__(self, "categorical", tuple(sorted(self.categorical)))
        object.__setattr__(self, "numerical", tuple(sorted(self.numerical)))

    @property
    def inputs(self) -> list[str]:
        """Ride columns the features are made from."""
        zones: list[str] = []
        for c in self.categorical:
            zones += ["PULocationID", "DOLocationID"] if c == PAIR else [c]
        return list(dict.fromkeys(zones + list(self.numerical)))

    def key(self, name: str):
        """The category of a feature as a column of the ride table."""
        return pair_key("PULocationID", "DOLocationID") if name == PAIR else zone_code(name)


ZONES = FeatureSpec()
PAIR_DISTANCE = FeatureSpec(("PU_DO",), ("trip_distance",))
ZONES_DISTANCE = FeatureSpec(("PULocationID", "DOLocationID"), ("trip_distance",))


def with_keys(rides: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Add one `<name>_key` text column per categorical feature."""
    return rides.withColumns({f"{c}_key": spec.key(c) for c in spec.categorical}) if spec.categorical else rides


def key_stage(spec: FeatureSpec) -> SQLTransformer:
    """`with_keys` as a pipeline stage."""

    def zone(c: str) -> str:
        return f"CAST(CAST(coalesce(nanvl(CAST({c} AS DOUBLE), NULL), {UNKNOWN_ZONE}) AS BIGINT) AS STRING)"

    def key(c: str) -> str:
        return f"concat_ws('_', {zone('PULocationID')}, {zone('DOLocationID')})" if c == PAIR else zone(c)

    keys = "".join(f", {key(c)} AS {c}_key" for c in spec.categorical)
    return SQLTransformer(statement=f"SELECT *{keys} FROM __THIS__")


def encoder(spec: FeatureSpec, one_hot: bool = True, on_missing: str = "error") -> Pipeline:
    """Rides to a `features` vector.

    Unseen and missing categories go to the indexer's extra last slot. `dropLast` removes exactly
    that slot, so known categories keep a full one-hot and unknown ones are all zero.
    `on_missing` decides about missing numbers: `error`, `keep` (NaN) or `skip` (drop the row).
    """
    cats = list(spec.categorical)
    stages = [key_stage(spec)]
    if cats:
        stages.append(
            StringIndexer(
                inputCols=[f"{c}_key" for c in cats],
                outputCols=[f"{c}_idx" for c in cats],
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            )
        )
        if one_hot:
            stages.append(
                OneHotEncoder(
                    inputCols=[f"{c}_idx" for c in cats], outputCols=[f"{c}_vec" for c in cats], dropLast=True
                )
            )
    names = {f"{c}=": f"{c}_vec" if one_hot else f"{c}_idx" for c in cats} | {n: n for n in spec.numerical}
    assembler = VectorAssembler(
        inputCols=[names[n] for n in sorted(names)], outputCol="features", handleInvalid=on_missing
    )
    return Pipeline(stages=[*stages, assembler])


def fit_encoder(rides: DataFrame, spec: FeatureSpec, one_hot: bool = True, on_missing: str = "error") -> PipelineModel:
    """The vocabulary is frozen in the pipeline: it lies on the driver and in every task, as Spark's
    encoders keep it. Least squares on one categorical needs none (see `operators.linear`)."""
    return encoder(spec, one_hot, on_missing).fit(rides)


def labels(model: PipelineModel) -> list[list[str]]:
    """Learned categories per categorical feature."""
    for stage in model.stages:
        if hasattr(stage, "labelsArray"):
            return [list(x) for x in stage.labelsArray]
    return []


def width(model: PipelineModel, spec: FeatureSpec) -> int:
    return sum(map(len, labels(model))) + len(spec.numerical)


def feature_names(model: PipelineModel, spec: FeatureSpec) -> list[str]:
    """Names in vector order: `name=value` per category, `name` per number."""
    groups = {f"{c}=": [f"{c}={v}" for v in vs] for c, vs in zip(spec.categorical, labels(model))}
    groups |= {n: [n] for n in spec.numerical}
    return [f for g in sorted(groups) for f in groups[g]]


def vocabulary(rides: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The vocabulary as a table (feature, index), numbered in byte order of the names.

    Duplicates go first, per task. Ranges of names are numbered on their own and shifted by the number
    of names in earlier ranges, so no task sees all of them. The ranges are written before they are
    counted: counting and numbering must see the same ones.
    """
    name = [F.concat(F.lit(f"{c}="), F.col(f"{c}_key")) for c in spec.categorical] + [F.lit(n) for n in spec.numerical]
    distinct = with_keys(rides, spec).select(F.explode(F.array(*name)).alias("feature")).distinct()
    ensure_checkpoint_dir(rides.sparkSession)
    ranged = distinct.repartitionByRange("feature").withColumn("range", F.spark_partition_id()).checkpoint()
    sizes = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))  # a row for each partition
    before = sizes.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("range").orderBy("feature")) - 1
    numbered = ranged.withColumn("within", within).join(F.broadcast(before), "range")
    return numbered.select("feature", (F.col("before") + F.col("within")).cast("int").alias("index"))


# Rows of a vocabulary (a name and a number each) that are sent to all executors instead of joined by key.
MAX_BROADCAST = 500_000


def joined(rides: DataFrame, names: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Append `features` (size, indices, values), a sparse vector as columns, by joins with the vocabulary
    `names` (feature, index): it stays a table, of any size. Unseen categories have no entry; a missing number
    fails the job."""
    names = names.persist()
    size = names.count()
    parts, encoded = [], with_keys(rides, spec)
    for c in spec.categorical:
        one = names.filter(F.col("feature").startswith(f"{c}=")).select(F.substr("feature", F.lit(len(c) + 2)).alias(f"{c}_key"), F.col("index").alias(f"{c}_at"))
        encoded = encoded.join(F.broadcast(one) if size <= MAX_BROADCAST else one, f"{c}_key", "left")
        parts.append(F.struct(F.col(f"{c}_at").alias("index"), F.lit(1.0).alias("value")))
    places = {r["feature"]: r["index"] for r in names.filter(F.col("feature").isin(list(spec.numerical))).collect()}  # one a number
    parts += [F.struct(F.lit(places[n]).alias("index"), required(n).alias("value")) for n in spec.numerical]
    filled = F.array_sort(F.filter(F.array(*parts), lambda e: e["index"].isNotNull() & (e["value"] != 0)))
    vector = F.struct(F.lit(size).alias("size"), filled["index"].alias("indices"), filled["value"].alias("values"))
    return encoded.select(*[F.col(c) for c in rides.columns], vector.alias("features"))


def joined_entries(encoded: DataFrame, keep: list[str]) -> DataFrame:
    """Entries of the vectors of `joined` as rows (index, value)."""
    entry = F.explode(F.arrays_zip(F.col("features.indices").alias("index"), F.col("features.values").alias("value")))
    return encoded.select(*keep, entry.alias("e")).select(*keep, F.col("e.index").alias("index"), F.col("e.value").alias("value"))


def vector_entries(encoded: DataFrame, keep: list[str], vector: str = "features") -> DataFrame:
    """Non-zero entries of a vector column as rows (index, value)."""
    v = F.unwrap_udt(vector)
    positions = F.when(v["type"] == 0, v["indices"]).otherwise(F.sequence(F.lit(0), F.size(v["values"]) - 1))
    entry = F.explode(F.arrays_zip(positions.alias("index"), v["values"].alias("value")))
    long = encoded.select(*keep, entry.alias("e"))
    return long.select(*keep, F.col("e.index").alias("index"), F.col("e.value").alias("value")).filter("value != 0")
