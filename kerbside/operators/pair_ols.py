"""Exact least squares for one categorical of any size plus one number, in one aggregation.

The categorical is absorbed: the slope comes from deviations inside each category, the effect of a
category is what remains of its mean. No vocabulary is gathered and no vector is built; categories
stay in a distributed table, and scoring is an equi-join on it. Small tables are broadcast by the
size Spark measures, large ones are joined by key with skewed keys split.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.columns import required


@dataclass
class PairOls:
    effects: DataFrame  # keys, effect
    slope: float
    intercept: float  # the mean effect: what an unseen category gets
    keys: list[str]
    number: str | None
    groups: DataFrame  # kept on the executors until released

    def release(self) -> None:
        self.groups.unpersist()


def fit(rows: DataFrame, keys: Sequence[str], number: str | None, label: str = "label", weight: str = "n") -> PairOls:
    """`rows` are cells or trips with a weight column; `keys` (no nulls) name the category.

    Without a number, or with one that never varies inside a category, the slope is 0. Missing
    numbers fail; sums would skip them without a word.

    Means come first and deviations from them second: a difference of large sums would leave rounding
    noise where there is no variation. The second pass joins one row per category, without a shuffle
    of the rows while the categories are few.
    """
    w, x, y = F.col(weight), required(number) if number else F.lit(0.0), F.col(label)
    mean_x = F.sum(w * x) / F.sum(w)
    if number:
        # Exact where the number is the same throughout: a weighted mean of 0.1 may not be 0.1.
        mean_x = F.when(F.min(x) == F.max(x), F.min(x)).otherwise(mean_x)
    groups = rows.groupBy(*keys).agg(mean_x.alias("mean_x"), (F.sum(w * y) / F.sum(w)).alias("mean_y"))
    # One row per category, read for the slope now and for the effects later.
    groups = groups.persist(StorageLevel.MEMORY_AND_DISK)
    means = groups.agg(F.avg("mean_x").alias("mx"), F.avg("mean_y").alias("my")).first()
    slope = 0.0
    if number:
        dx, dy = x - F.col("mean_x"), y - F.col("mean_y")
        within = rows.join(groups, list(keys)).agg(F.sum(w * dx * dx).alias("sxx"), F.sum(w * dx * dy).alias("sxy")).first()
        slope = within["sxy"] / within["sxx"] if within["sxx"] else 0.0
    effects = groups.select(*keys, (F.col("mean_y") - F.lit(slope) * F.col("mean_x")).alias("effect"))
    return PairOls(effects, slope, means["my"] - slope * means["mx"] if means["my"] is not None else 0.0, list(keys), number, groups)


def predict(model: PairOls, rows: DataFrame) -> DataFrame:
    joined = rows.join(model.effects, model.keys, "left")
    base = F.coalesce("effect", F.lit(model.intercept))
    shift = F.lit(model.slope) * required(model.number) if model.number else F.lit(0.0)
    return joined.withColumn("prediction", base + shift).drop("effect")
