"""Trip tables: monthly files per colour, and the canonical table everything else works on."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.columns import as_timestamp

# The file name of a month and the time columns of each colour.
FILE_PATTERN = "{color}_tripdata_{year:04d}-{month:02d}.parquet"
TIME_COLUMNS = {
    "green": ("lpep_pickup_datetime", "lpep_dropoff_datetime"),
    "yellow": ("tpep_pickup_datetime", "tpep_dropoff_datetime"),
}

CANONICAL = (
    "pickup_datetime TIMESTAMP_NTZ, dropoff_datetime TIMESTAMP_NTZ, PULocationID BIGINT, "
    "DOLocationID BIGINT, trip_distance DOUBLE, color STRING, year INT, month INT"
)
SOURCE_FILE = "source_file"
SOURCE_ROW = "source_row"


def month_path(color: str, year: int, month: int, base: str = "", pattern: str | None = None) -> str:
    """Path of one month. `pattern` may be any format string over color, year and month."""
    name = (pattern or FILE_PATTERN).format(color=color, year=year, month=month)
    return f"{base.rstrip('/')}/{name}" if base else name


def following_month(year: int, month: int) -> tuple[int, int]:
    return (year + month // 12, month % 12 + 1)


def canonical(raw: DataFrame, color: str, year: int | None = None, month: int | None = None) -> DataFrame:
    """Project a colour's raw layout to the canonical columns.

    Without year and month they come from the pickup time. Columns of the row position, when the
    scan captured them, are kept.
    """
    if color not in TIME_COLUMNS:
        raise ValueError(f"unknown trip colour {color!r}; known: {sorted(TIME_COLUMNS)}")
    pickup, dropoff = (as_timestamp(c) for c in TIME_COLUMNS[color])
    distance = F.col("trip_distance").cast("double") if "trip_distance" in raw.columns else F.lit(None).cast("double")
    return raw.select(
        pickup.alias("pickup_datetime"),
        dropoff.alias("dropoff_datetime"),
        _zone(raw, "PULocationID"),
        _zone(raw, "DOLocationID"),
        distance.alias("trip_distance"),
        F.lit(color).alias("color"),
        (F.lit(year) if year else F.year(pickup)).cast("int").alias("year"),
        (F.lit(month) if month else F.month(pickup)).cast("int").alias("month"),
        *[c for c in (SOURCE_FILE, SOURCE_ROW) if c in raw.columns],
    )


def with_position(scan: DataFrame) -> DataFrame:
    """Add file and row position. Must be applied to the scan itself, before anything reorders rows."""
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.row_index").alias(SOURCE_ROW),
    )


def read_month(
    spark: SparkSession, base: str, color: str, year: int, month: int, pattern: str | None = None
) -> DataFrame:
    """One month as canonical trips with row positions. Lazy; only the canonical columns are read."""
    scan = spark.read.parquet(month_path(color, year, month, base, pattern))
    return canonical(with_position(scan), color, year, month)


def read_months(
    spark: SparkSession, base: str, months: Iterable[tuple[str, int, int]], pattern: str | None = None
) -> DataFrame:
    """Several months as one table. Each file keeps its own schema (zone types drift between months)."""
    frames = [read_month(spark, base, *m, pattern=pattern) for m in months]
    return reduce(DataFrame.unionByName, frames)


def write_canonical(trips: DataFrame, path: str, by_month: bool = True) -> None:
    """Store trips partitioned by colour, year and month, so later reads prune whole months.

    Monthly files are already apart and are written as they are read. Pass `by_month=False` for
    sources that mix months: every task would write a file per month, so rows are brought together
    first, in partitions of even size (a large month is split, small ones are merged).
    """
    columns = [f.split()[0] for f in CANONICAL.split(", ")]
    table = trips.select(*columns)
    if not by_month:
        table = table.hint("rebalance", "color", "year", "month")
    (
        table.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("color", "year", "month")
        .parquet(path)
    )


def read_canonical(spark: SparkSession, path: str) -> DataFrame:
    return with_position(spark.read.schema(CANONICAL).parquet(path))


def _zone(raw: DataFrame, name: str):
    c = F.col(name)
    if raw.schema[name].dataType.typeName() in ("double", "float"):
        c = F.nanvl(c, F.lit(None))
    return c.cast("bigint").alias(name)
