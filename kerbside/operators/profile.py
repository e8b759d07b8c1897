"""Reports over trips and predictions. Each is one aggregation with map-side partial results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.columns import in_bounds, is_missing


def shape(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(table.columns)))


def column_types(table: DataFrame) -> list[tuple[str, str]]:
    return table.dtypes


def preview(table: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First rows in a stated order (a top-k per task, never a full sort)."""
    return table.orderBy(*order).limit(n)


def retention(trips: DataFrame, duration: str = "duration", by: Sequence[str] = ()) -> DataFrame:
    """Rows, kept rows and kept share in percent, in one pass over the unfiltered table."""
    kept = F.coalesce(in_bounds(duration), F.lit(False)).cast("int")
    return trips.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(kept).alias("n_kept"),
        (F.avg(kept) * 100).alias("retention_pct"),
    )


def missing_check(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column whether any value is missing (null or NaN)."""
    return table.agg(*[F.coalesce(F.bool_or(is_missing(c)), F.lit(False)).alias(f"{c}_missing") for c in columns])


def distribution(table: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, both standard deviations, sum and range of a column."""
    return table.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std_sample"),
        F.stddev_pop(value).alias("std_population"),
        F.sum(value).alias("total"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    )


def histogram(table: DataFrame, values: Sequence[str], low: float, high: float, bins: int) -> DataFrame:
    """Counts per equal-width bucket for one or more columns (say prediction and actual).

    Bucket `i` covers [low + i*width, low + (i+1)*width); the last also takes `high`. Values outside
    fall into buckets -1 and `bins`.
    """
    width = (high - low) / bins
    kinds = F.explode(F.array(*[F.struct(F.lit(v).alias("kind"), F.col(v).alias("v")) for v in values]))
    v = F.col("x.v")
    bucket = (
        F.when(v < low, -1)
        .when(v == high, bins - 1)
        .when(v > high, bins)
        .otherwise(F.floor((v - F.lit(low)) / F.lit(width)).cast("int"))
    )
    long = table.select(kinds.alias("x")).filter(v.isNotNull() & ~F.isnan(v))
    return long.groupBy(F.col("x.kind").alias("kind"), bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def feature_count(table: DataFrame, categorical: Sequence[str], numerical: Sequence[str] = (), exact: bool = True):
    """Number of one-hot features: distinct values of all categoricals plus the numeric columns.

    Duplicates are removed per column before the count, so a value shared by a third of all rows
    leaves each task once. `exact=False` counts with sketches instead.
    """
    if not exact:
        parts = [F.approx_count_distinct(c) for c in categorical]
        return table.agg((sum(parts, F.lit(0)) + len(numerical)).alias("n_features"))
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in categorical]))
    distinct = table.select(pairs.alias("f")).distinct()
    return distinct.agg((F.count(F.lit(1)) + len(numerical)).alias("n_features"))


def file_inventory(scan: DataFrame) -> DataFrame:
    """Files of a table with their size and rows, from scan metadata (no data column is read)."""
    files = scan.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("n_bytes")
    )
    return files.groupBy("path", "n_bytes").agg(F.count(F.lit(1)).alias("n_rows"))


def artifact_files(spark, folder: str, suffix: str = "") -> DataFrame:
    """All files below a folder with their size; the contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "length").filter(F.col("path").endswith(suffix))
