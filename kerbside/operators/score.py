"""Batch scoring: trips in, `(ride_id, predicted_duration)` out, in one stage without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.codec import CORRUPT
from kerbside.functions.columns import is_missing
from kerbside.operators.numbering import dense_ride_ids, source_ride_ids
from kerbside.operators.prepare import drop_outliers
from kerbside.operators.train import predict

# Where predictions of one month go.
OUTPUT_PATTERN = "taxi_type={color}/year={year:04d}/month={month:02d}"


def score_trips(model, trips: DataFrame, numbering: str = "source") -> DataFrame:
    """Canonical trips with row positions to predictions, with the partition columns of the output."""
    kept = drop_outliers(trips)
    if numbering not in ("source", "dense"):
        raise ValueError(f"unknown numbering {numbering!r}; known: source, dense")
    numbered = source_ride_ids(kept, trips) if numbering == "source" else dense_ride_ids(kept)
    return result_columns(predict(model, numbered))


def result_columns(scored: DataFrame) -> DataFrame:
    return scored.select(
        "ride_id",
        F.col("prediction").alias("predicted_duration"),
        F.col("color").alias("taxi_type"),
        "year",
        "month",
    )


def request_reason(model, requests: DataFrame) -> Column:
    """Why a request cannot be answered, judged as stream records are; null when it can."""
    numbers = model.spec.numerical if hasattr(model, "spec") else ()
    missing = reduce(or_, [is_missing(n) for n in numbers], F.lit(False))
    reason = F.when(missing, "input missing")
    return F.when(F.col(CORRUPT).isNotNull(), "no JSON").otherwise(reason) if CORRUPT in requests.columns else reason


def score_requests(model, requests: DataFrame, run_id: str | None = None) -> DataFrame:
    """A table (or stream) of single rides to responses: the request, its duration, the model. Requests
    that cannot be answered are left to `request_rejects`."""
    usable = requests.filter(request_reason(model, requests).isNull()).drop(CORRUPT)
    scored = predict(model, usable).withColumnRenamed("prediction", "duration")
    return scored.withColumn("model_version", F.lit(run_id).cast("string"))


def request_rejects(model, requests: DataFrame) -> DataFrame:
    """The other requests, with the reason."""
    return requests.withColumn("reason", request_reason(model, requests)).filter("reason IS NOT NULL")


def watched(predictions: DataFrame, value: str = "predicted_duration") -> tuple[DataFrame, Observation]:
    """The predictions, and the numbers behind `summary` that their next write will leave: no second pass."""
    seen = Observation()
    v = F.col(value)
    return predictions.observe(seen, F.count(v).alias("n"), F.sum(v).alias("total"), F.avg(v).alias("mean"), F.var_pop(v).alias("variance")), seen


def watched_summary(spark: SparkSession, seen: Sequence[Observation]) -> DataFrame:
    """`summary` of what several watched writes have written together."""
    n, total, spread = 0, 0.0, 0.0
    for x in (o.get for o in seen):
        if x["n"]:
            # The spread inside both parts, and that of their means.
            between = (x["mean"] - total / n) ** 2 * n * x["n"] / (n + x["n"]) if n else 0.0
            n, total, spread = n + x["n"], total + x["total"], spread + x["variance"] * x["n"] + between
    row = (n, total, total / n, (spread / n) ** 0.5) if n else (0, None, None, None)
    return spark.createDataFrame([row], "n BIGINT, total DOUBLE, mean DOUBLE, std_population DOUBLE")


def write_month(predictions: DataFrame, path: str, compression: str = "uncompressed") -> None:
    """The predictions of one month to a folder of its own, which is overwritten."""
    predictions.drop("taxi_type", "year", "month").write.mode("overwrite").option("compression", compression).parquet(path)


def write_predictions(predictions: DataFrame, path: str, compression: str = "uncompressed") -> None:
    """Overwrite exactly the months present; a re-run replaces its own output only.

    The scan reads month by month, so tasks already hold one or two months each and the partitioned
    write needs no shuffle.
    """
    (
        predictions.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy("taxi_type", "year", "month")
        .parquet(path)
    )


def output_path(color: str, year: int, month: int, base: str = "", pattern: str | None = None) -> str:
    name = (pattern or OUTPUT_PATTERN).format(color=color, year=year, month=month)
    return f"{base.rstrip('/')}/{name}" if base else name


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    schema = "ride_id STRING, predicted_duration DOUBLE, taxi_type STRING, year INT, month INT"
    return spark.read.schema(schema).parquet(path)


def summary(predictions: DataFrame, value: str = "predicted_duration") -> DataFrame:
    """Rows, sum, mean and population deviation of the predictions."""
    return predictions.agg(
        F.count(value).alias("n"),
        F.sum(value).alias("total"),
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("std_population"),
    )
