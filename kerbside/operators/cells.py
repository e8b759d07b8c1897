"""Collapse trips to cells before any fit.

A cell is one combination of feature values (and split) with the number of its trips, their mean
label and the squared deviations around it. Least squares, regression-tree gains and RMSE depend on
the trips only through these three numbers, so a weighted fit on cells equals the fit on trips.

One scan and one shuffle turn the trip table into cells. Each task sends at most one row per cell,
so a zone that holds a third of all trips is no hot key. With zones only, the number of cells is
bounded by zones squared, whatever the number of trips. With numbers it is bounded by bins times that:
trees cut a number at quantiles anyway, so distances between two of `BINS` quantiles may share a cell,
which has their mean. Numbers of few values keep them all. All fits, searches and evaluations then
work on the cells.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.columns import zone_number
from kerbside.operators.encode import FeatureSpec

WEIGHT = "n"
LABEL = "label"
SPREAD = "spread"
BINS = 256


def _inputs(spec: FeatureSpec) -> list[Column]:
    return [F.col(c) if c in spec.numerical else zone_number(c).alias(c) for c in spec.inputs]


def edges(trips: DataFrame, spec: FeatureSpec, bins: int = BINS) -> dict[str, list[float]]:
    """At most `bins` - 1 quantiles of every number, from a sketch that tasks merge."""
    shares = [k / bins for k in range(1, bins)]
    if not spec.numerical:
        return {}
    found = trips.agg(*(F.percentile_approx(F.col(n).cast("double"), shares, 20 * bins).alias(n) for n in spec.numerical)).first()
    return {n: sorted({x for x in found[n] or [] if x == x}) for n in spec.numerical}


def collapse(
    trips: DataFrame, spec: FeatureSpec, label: str = "duration", by: Sequence[str] = ("split",), binned: Mapping[str, list[float]] | None = None
) -> DataFrame:
    """Cells of all combinations of inputs; numbers in `binned` (see `edges`) by bin, with their mean."""
    rows = trips.select(*by, *_inputs(spec), F.col(label).alias(LABEL))
    keys = [f"_bin_{c}" if c in (binned or {}) else c for c in spec.inputs]
    for n, at in (binned or {}).items():
        splits = [float("-inf"), *at, float("inf")] if at else [float("-inf"), 0.0, float("inf")]
        rows = rows.withColumn(f"_at_{n}", F.col(n).cast("double"))
        rows = Bucketizer(splits=splits, inputCol=f"_at_{n}", outputCol=f"_bin_{n}", handleInvalid="keep").transform(rows)
    # Exact where a cell has one value: a mean of 0.1 may not be 0.1.
    means = [F.when(F.min(n) == F.max(n), F.min(n)).otherwise(F.avg(n)).alias(n) for n in binned or {}]
    cells = rows.groupBy(*by, *keys).agg(
        F.count(F.lit(1)).cast("double").alias(WEIGHT),
        F.avg(LABEL).alias("_mean"),
        (F.var_pop(LABEL) * F.count(F.lit(1))).alias(SPREAD),
        *means,
    )
    return cells.select(*by, *spec.inputs, WEIGHT, F.col("_mean").alias(LABEL), SPREAD)


def uncollapsed(trips: DataFrame, spec: FeatureSpec, label: str = "duration", by: Sequence[str] = ("split",)) -> DataFrame:
    """The same columns with one cell per trip (no shuffle), for features that hardly repeat."""
    return trips.select(
        *by, *_inputs(spec), F.lit(1.0).alias(WEIGHT), F.col(label).alias(LABEL), F.lit(0.0).alias(SPREAD)
    )


def rmse(prediction: str = "prediction") -> Column:
    """RMSE over the trips behind the cells: distance of the cell mean plus the spread inside."""
    error = F.col(WEIGHT) * F.pow(F.col(LABEL) - F.col(prediction), 2) + F.col(SPREAD)
    return F.sqrt(F.sum(error) / F.sum(WEIGHT))
