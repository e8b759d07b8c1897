"""Score whole months with a saved model."""

from __future__ import annotations

from collections.abc import Iterable
from pyspark.sql import DataFrame, SparkSession

from kerbside.operators import registry, score
from kerbside.operators import train as models
from kerbside.sources.trips import read_months


def score_months(
    spark: SparkSession,
    base: str,
    months: Iterable[tuple[str, int, int]],
    model_path: str,
    dest: str,
    numbering: str = "source",
    pattern: str | None = None,
    output: str | None = None,
) -> DataFrame:
    """Read months, score, write Parquet; returns the summary of what was written, as seen by the write.

    By default all months are written at once, to partitions by colour, year and month. With `output`, a
    pattern of `color`, `year` and `month`, each month goes to a folder of that name.
    """
    model = models.load(spark, model_path)
    months = list(months)
    seen = []
    for part in [[m] for m in months] if output else [months]:
        predictions, numbers = score.watched(score.score_trips(model, read_months(spark, base, part, pattern), numbering))
        if output:
            score.write_month(predictions, score.output_path(*part[0], dest, output))
        else:
            score.write_predictions(predictions, dest)
        seen.append(numbers)
    return score.watched_summary(spark, seen)


def load_by_alias(spark: SparkSession, root: str, experiment: str, model: str, alias: str) -> models.Trained:
    run_id = registry.run_by_alias(registry.read_aliases(spark, f"{root}/aliases"), model, alias)
    return models.load(spark, models.model_location(run_id, root, experiment=experiment))
