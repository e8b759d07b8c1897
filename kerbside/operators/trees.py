"""Changes to fitted trees, made on the tables that Spark ML saves them as.

A saved ensemble is a table of nodes (tree, id, children, split, statistics), one of trees with their
weights, and a line of metadata. Nodes and trees are changed there, as columns, and read back as a model
of the same kind; nothing is fitted again.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.session import new_folder

Ensemble = RandomForestRegressionModel | GBTRegressionModel


def _same(frame: DataFrame) -> DataFrame:
    return frame


def _rewritten(
    model: Ensemble,
    nodes: Callable[[DataFrame], DataFrame] = _same,
    trees: Callable[[DataFrame], DataFrame] = _same,
    about: Callable[[dict], dict] = dict,
) -> Ensemble:
    spark = SparkSession.active()
    before, after = new_folder(spark, "trees"), new_folder(spark, "trees")
    model.write().save(before)
    nodes(spark.read.parquet(f"{before}/data")).write.parquet(f"{after}/data")
    trees(spark.read.parquet(f"{before}/treesMetadata")).write.parquet(f"{after}/treesMetadata")
    line = json.dumps(about(json.loads(spark.read.text(f"{before}/metadata").first()["value"])))
    spark.createDataFrame([(line,)], "value STRING").coalesce(1).write.text(f"{after}/metadata")
    return type(model).load(after)


def pruned(model: Ensemble, least: int) -> Ensemble:
    """The model that a fit would give if nodes of fewer than `least` trips may not be split.

    A split depends on what is above it and not on its children, so a node that is too small becomes a leaf
    with the answer it has. The first statistic of a node is the weight of its trips.
    """
    node = F.col("nodeData")
    nothing = F.struct(
        F.lit(-1).alias("featureIndex"), F.array().cast("array<double>").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories")
    )
    leaf = node.withField("leftChild", F.lit(-1)).withField("rightChild", F.lit(-1)).withField("gain", F.lit(-1.0)).withField("split", nothing)
    small = F.round(node["impurityStats"][0], 6) < least  # sums of parts of cells
    return _rewritten(model, lambda nodes: nodes.withColumn("nodeData", F.when(small, leaf).otherwise(node)))


def shortened(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The first `rounds` trees of a boosted model with their weights: what fewer rounds would have given."""

    def about(found: dict) -> dict:
        return {**found, "numTrees": rounds, "paramMap": {**found["paramMap"], "maxIter": rounds}}

    return _rewritten(model, lambda nodes: nodes.filter(F.col("treeID") < rounds), lambda trees: trees.filter(F.col("_1") < rounds), about)


def regrown(model: RandomForestRegressionModel, found: DataFrame, params: dict) -> RandomForestRegressionModel:
    """A forest with other nodes (as saved ones, of as many trees), and the parameters they were grown with."""
    return _rewritten(model, nodes=lambda _: found, about=lambda line: {**line, "paramMap": {**line["paramMap"], **params}})


def reboosted(model: GBTRegressionModel, found: DataFrame, rounds: int, params: dict) -> GBTRegressionModel:
    """A boosted model with other nodes (as saved ones, of `rounds` trees), and the parameters they were grown with. `model`
    has two rounds, or one if there is no more; the later trees have the weight of its second one."""

    def weights(trees: DataFrame) -> DataFrame:
        each = F.explode(F.when(F.col("_1") == 0, F.array(F.lit(0))).otherwise(F.sequence(F.lit(1), F.lit(max(1, rounds - 1)))))
        return trees.select(each.alias("_1"), *trees.columns[1:])

    def about(line: dict) -> dict:
        return {**line, "numTrees": rounds, "paramMap": {**line["paramMap"], **params, "maxIter": rounds}}

    return _rewritten(model, lambda _: found, weights, about)
