"""Linear models kept as what they are: an effect per category, a slope per number, an intercept.

One-hot blocks plus an intercept are collinear: effects may be shifted against each other and against
the intercept without any effect on known rides. The solution of least norm is kept, as a solver that
centres its columns returns it; its intercept is the answer for a ride of unseen zones.

Effects are tables of one row per category. Tables of at most MAX_BROADCAST rows are held by the driver
and sent to all executors, so scoring is one stage without a vector per row; larger ones lie in the shared
folder and are joined by key. Unseen categories find nothing and add zero.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.columns import required, zone_number
from kerbside.operators import cells as cell
from kerbside.operators import conjugate, pair_ols
from kerbside.operators.encode import PAIR, FeatureSpec, feature_names, fit_encoder, labels
from kerbside.session import ensure_checkpoint_dir, new_folder

# Rows of an effect table (about 40 bytes each) that every executor may hold.
MAX_BROADCAST = 500_000
# Rows that the driver keeps as a local table; larger ones are written to the shared folder.
MAX_HELD = 10_000

# Columns up to which Spark solves the normal equations, and so categories that pass through the driver.
# Beyond, conjugate gradients over effect tables find the same solution to their tolerance.
MAX_NORMAL_COLUMNS = 4096


def zones_of(name: str) -> list[str]:
    return ["PULocationID", "DOLocationID"] if name == PAIR else [name]


@dataclass
class LinearEffects:
    intercept: float
    numbers: dict[str, float] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)  # `_<name>_0`, ..., `_<name>_effect`
    sizes: dict[str, int] = field(default_factory=dict)

    def predict(self, rides: DataFrame) -> DataFrame:
        total = F.lit(self.intercept)
        joined = rides
        for name, table in self.tables.items():
            same = reduce(and_, [zone_number(z) == F.col(f"_{name}_{i}") for i, z in enumerate(zones_of(name))])
            joined = joined.join(F.broadcast(table) if self.sizes[name] <= MAX_BROADCAST else table, same, "left")
            total = total + F.coalesce(f"_{name}_effect", F.lit(0.0))
        for name, slope in self.numbers.items():
            # A missing number must fail, not turn into a null answer.
            total = total + F.lit(slope) * required(name)
        return joined.select(*[F.col(c) for c in rides.columns], total.alias("prediction"))

    def weights(self) -> dict[str, float]:
        """Weight per feature name, `name=value` for categories; for reports on small models."""
        found = dict(self.numbers)
        for name, table in self.tables.items():
            for row in table.collect():
                found[f"{name}={'_'.join(str(v) for v in row[:-1])}"] = row[-1]
        return dict(sorted(found.items()))

    def save(self, path: str) -> None:
        for name, table in self.tables.items():
            table.write.mode("overwrite").parquet(f"{path}/effects/{name}")
        about = {"intercept": self.intercept, "numbers": self.numbers, "sizes": self.sizes}
        spark = SparkSession.active()
        spark.createDataFrame([(json.dumps(about),)], "value STRING").coalesce(1).write.mode("overwrite").text(f"{path}/linear")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearEffects:
        about = json.loads(spark.read.text(f"{path}/linear").first()["value"])
        tables = {name: spark.read.parquet(f"{path}/effects/{name}") for name in about["sizes"]}
        return cls(about["intercept"], about["numbers"], tables, about["sizes"])


def _held(name: str, effects: DataFrame) -> tuple[DataFrame, int]:
    """An effect table (zones, effect) that no longer depends on the trips."""
    spark = effects.sparkSession
    named = effects.select(*[F.col(z).alias(f"_{name}_{i}") for i, z in enumerate(zones_of(name))], F.col("effect").alias(f"_{name}_effect"))
    size = named.count()
    if size <= MAX_HELD:
        return spark.createDataFrame(named.toArrow()), size
    path = new_folder(spark, "effects")
    named.write.parquet(path)
    return spark.read.parquet(path), size


def fit(train: DataFrame, spec: FeatureSpec, columns: int | None = None) -> LinearEffects:
    """Ordinary least squares on cells or trips with a weight, without a penalty that would bend rare
    categories. Of several categoricals with more than `columns` categories (by default
    `MAX_NORMAL_COLUMNS`) the effects are found as tables."""
    if not spec.categorical:
        solved = _least_squares(fit_encoder(train, spec).transform(train))
        return LinearEffects(solved.intercept, dict(zip(spec.numerical, map(float, solved.coefficients))))
    if len(spec.categorical) == 1 and len(spec.numerical) <= 1:
        # One categorical of any size: its effects are one aggregation and stay distributed.
        (name,), number = spec.categorical, spec.numerical[0] if spec.numerical else None
        solved = pair_ols.fit(train, zones_of(name), number, cell.LABEL, cell.WEIGHT)
        try:
            above = solved.effects.withColumn("effect", F.col("effect") - F.lit(solved.intercept))
            table, size = _held(name, above)
        finally:
            solved.release()
        return LinearEffects(solved.intercept, {number: solved.slope} if number else {}, {name: table}, {name: size})
    rows = _moments(train, spec).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _several(rows, spec, MAX_NORMAL_COLUMNS if columns is None else columns)
    finally:
        rows.unpersist()


def _least_squares(encoded: DataFrame, features: str = "features"):
    return LinearRegression(
        solver="normal", regParam=0.0, tol=1e-12, maxIter=1000, labelCol=cell.LABEL, weightCol=cell.WEIGHT, featuresCol=features
    ).fit(encoded)


def _moments(train: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Few rows per combination of zones that least squares cannot tell from the trips: one, or with a
    number two that have its mean and spread, and its co-variation with the label."""
    zones = list(dict.fromkeys(z for name in spec.categorical for z in zones_of(name)))
    if len(spec.numerical) > 1:
        return train.select(*zones, *spec.numerical, cell.WEIGHT, cell.LABEL)
    w, y = F.col(cell.WEIGHT), F.col(cell.LABEL)
    if not spec.numerical:
        mean = (F.sum(w * y) / F.sum(w)).alias("_mean")
        return train.groupBy(*zones).agg(F.sum(w).alias("_w"), mean).select(*zones, F.col("_w").alias(cell.WEIGHT), F.col("_mean").alias(cell.LABEL))
    (number,) = spec.numerical
    x = required(number)
    mean_x = F.when(F.min(x) == F.max(x), F.min(x)).otherwise(F.sum(w * x) / F.sum(w))
    means = train.groupBy(*zones).agg(F.sum(w).alias("_w"), mean_x.alias("_x"), (F.sum(w * y) / F.sum(w)).alias("_y"))
    dx, dy = x - F.col("_x"), y - F.col("_y")
    spread = train.join(means, zones).groupBy(*zones).agg(
        *[F.first(c).alias(c) for c in ("_w", "_x", "_y")], F.sum(w * dx * dx).alias("_xx"), F.sum(w * dx * dy).alias("_xy")
    )
    off = F.sqrt(F.col("_xx") / F.col("_w"))
    tilt = F.try_divide(F.col("_xy") / F.col("_w"), off)
    point = lambda side, share: F.struct(
        (F.col("_x") + side * off).alias(number), (F.col("_w") * share).alias(cell.WEIGHT), (F.col("_y") + side * F.coalesce(tilt, F.lit(0.0))).alias(cell.LABEL)
    )
    points = F.when(F.col("_xx") > 0, F.array(point(-1, 0.5), point(1, 0.5))).otherwise(F.array(point(0, 1.0)))
    return spread.select(*zones, F.explode(points).alias("_point")).select(*zones, "_point.*")


def _several(rows: DataFrame, spec: FeatureSpec, most: int) -> LinearEffects:
    """Several categoricals (or numbers): few categories by the normal equations of their one-hot columns, any
    number of them as tables by conjugate gradients. Both end in the solution of least norm."""
    zones = list(dict.fromkeys(z for name in spec.categorical for z in zones_of(name)))
    known = rows.groupBy(*zones).agg(F.sum(cell.WEIGHT).alias(cell.WEIGHT))
    columns = sum(known.agg(*(F.count_distinct(spec.key(c)) for c in spec.categorical)).first()) + len(spec.numerical)
    return _as_columns(rows, known, spec) if columns <= most else _as_tables(rows, spec)


def _as_tables(rows: DataFrame, spec: FeatureSpec) -> LinearEffects:
    solved = conjugate.solve(rows, spec, cell.WEIGHT, cell.LABEL)
    tables, sizes = {}, {}
    for name, found in solved.effects.items():
        parts = F.split("key", "_")
        tables[name], sizes[name] = _held(name, found.select(*(parts[i].cast("bigint").alias(z) for i, z in enumerate(zones_of(name))), "effect"))
    return LinearEffects(solved.intercept, solved.slopes, tables, sizes)


def _as_columns(rows: DataFrame, known: DataFrame, spec: FeatureSpec) -> LinearEffects:
    """Columns become independent if one category of the first feature is left out, and one on each island
    of every other; all driver-held parts are bounded by the number of columns."""
    encoder = fit_encoder(known, spec)
    names = feature_names(encoder, spec)
    categories = dict(zip(spec.categorical, labels(encoder)))
    islands = _islands(known, spec, categories)
    encoded = encoder.transform(rows)
    left_out = _left_out(known, spec, islands)
    kept = [i for i, n in enumerate(names) if n not in left_out]
    solved = _least_squares(VectorSlicer(inputCol="features", outputCol="contrast", indices=kept).transform(encoded), "contrast")
    coefficient = dict.fromkeys(names, 0.0) | {names[i]: float(v) for i, v in zip(kept, solved.coefficients)}
    effects = {c: {v: coefficient[f"{c}={v}"] for v in vs} for c, vs in categories.items()}
    intercept = solved.intercept + _to_least_norm(effects, islands)
    spark, tables, sizes = rows.sparkSession, {}, {}
    for name, found in effects.items():
        keys = zip(*[map(int, category.split("_")) for category in found])
        columns = {f"_{name}_{i}": pa.array(k, pa.int64()) for i, k in enumerate(keys)}
        tables[name] = spark.createDataFrame(pa.table(columns | {f"_{name}_effect": pa.array(found.values(), pa.float64())}))
        sizes[name] = len(found)
    return LinearEffects(intercept, {n: coefficient[n] for n in spec.numerical}, tables, sizes)


def _islands(known: DataFrame, spec: FeatureSpec, categories: Mapping[str, list[str]]) -> dict[str, dict[str, int]]:
    """For two zone features, the connected part of the zone graph that each category lies in."""
    one = {c: dict.fromkeys(vs, 0) for c, vs in categories.items()}
    if len(spec.categorical) != 2 or PAIR in spec.categorical:
        return one
    a, b = spec.categorical
    edges = known.select(a, b)
    if edges.groupBy(a).agg(F.count_distinct(b).alias("n")).agg(F.max("n")).first()[0] == len(categories[b]):
        return one  # some zone meets all of the other feature
    ensure_checkpoint_dir(known.sparkSession)
    of_a, before = edges.groupBy(a).agg(F.min(b).alias("island")).checkpoint(), None
    while True:
        of_b = edges.join(of_a, a).groupBy(b).agg(F.min("island").alias("island")).checkpoint()
        of_a = edges.join(of_b, b).groupBy(a).agg(F.min("island").alias("island")).checkpoint()
        now = of_a.agg(F.sum("island")).first()[0]
        if now == before:  # labels only fall, so an equal sum means equal labels
            return {c: {str(r[0]): r["island"] for r in t.select(c, "island").collect()} for c, t in ((a, of_a), (b, of_b))}
        before = now


def _left_out(known: DataFrame, spec: FeatureSpec, islands: Mapping[str, Mapping[str, int]]) -> set[str]:
    """The most frequent category of the first feature, and of each island of the others."""
    out = set()
    for k, c in enumerate(spec.categorical):
        best: dict = {}
        for row in known.groupBy(spec.key(c).alias("value")).agg(F.sum(cell.WEIGHT).alias("w")).collect():
            part = islands[c][row["value"]] if k else 0
            best[part] = max(best.get(part, (0.0, "")), (row["w"], row["value"]))
        out |= {f"{c}={value}" for _, value in best.values()}
    return out


def _to_least_norm(effects: dict[str, dict[str, float]], islands: Mapping[str, Mapping[str, int]]) -> float:
    """Shift effects to the least sum of squares; returns what moves to the intercept.

    On an island all effects of one feature may rise and all of the other fall by as much, and the sum of
    both may move to the intercept, by the same amount on every island. Several features on one
    island just lose their means.
    """
    if len(effects) != 2:
        moved = 0.0
        for found in effects.values():
            mean = sum(found.values()) / len(found)
            found.update({v: e - mean for v, e in found.items()})
            moved += mean
        return moved
    (a, first), (b, second) = effects.items()
    parts: dict = defaultdict(lambda: ([], []))
    for side, (c, found) in enumerate(((a, first), (b, second))):
        for value, effect in found.items():
            parts[islands[c][value]][side].append(effect)
    mean = {k: [sum(x) / len(x) for x in sides] for k, sides in parts.items()}
    # With s moved to the intercept, an island's means u and v become shares of u + v - s; the squares
    # cost (u + v - s)^2 * n * m / (n + m), so s is a weighted mean of u + v.
    pull = {k: len(x) * len(y) / (len(x) + len(y)) for k, (x, y) in parts.items()}
    moved = sum(pull[k] * sum(mean[k]) for k in parts) / sum(pull.values())
    for side, (c, found) in enumerate(((a, first), (b, second))):
        for value, effect in found.items():
            k = islands[c][value]
            share = len(parts[k][1 - side]) / (len(parts[k][0]) + len(parts[k][1]))
            found[value] = effect - mean[k][side] + (sum(mean[k]) - moved) * share
    return moved
