"""Trips derived from the general test tables, row by row (no join, no shuffle).

Zones are a closed set: any key column is folded into `ZONES` codes, as a city has a fixed number
of taxi zones no matter how many trips it records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.columns import duration_minutes
from kerbside.sources.trips import SOURCE_FILE, SOURCE_ROW, TIME_COLUMNS, with_position

ZONES = 265


def event_trips(spark: SparkSession, sf_dir: str, positions: bool = False) -> DataFrame:
    """Trips from `events`: one month, both colours, some unknown pickup zones, one trip per event."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    if positions:
        events = with_position(events)
    pickup_zone = F.when(F.col("event_type") != "error", (F.col("user_id") % ZONES + 1).cast("double"))
    day = F.dayofmonth("pickup_datetime")
    return events.select(
        "event_id",
        "event_type",
        F.col("ts").alias("pickup_datetime"),
        (F.col("ts") + F.expr("INTERVAL '1' MINUTE") * F.col("value")).alias("dropoff_datetime"),
        pickup_zone.alias("PULocationID"),
        # `props` is one flat number; a pattern reads it several times faster than a JSON parser.
        F.regexp_extract("props", r'"k":\s*(-?\d+)', 1).cast("bigint").alias("DOLocationID"),
        ((F.col("event_id") % 100).cast("double") / F.lit(10.0)).alias("trip_distance"),
        F.when(F.col("event_type").isin("view", "click"), "green").otherwise("yellow").alias("color"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        *([SOURCE_FILE, SOURCE_ROW] if positions else []),
    ).select(
        "*",
        # One month only, so its thirds stand in for the three monthly files.
        F.when(day <= 10, "train").when(day <= 20, "val").otherwise("test").alias("split"),
        duration_minutes("pickup_datetime", "dropoff_datetime").alias("duration"),
    )


def lineitem_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips from `lineitem`: many years, both colours, one scan."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").filter(F.col("l_linestatus").isin("O", "F"))
    trips = rows.select(
        F.col("l_shipdate").alias("pickup_datetime"),
        (F.col("l_shipdate") + _lineitem_length()).alias("dropoff_datetime"),
        *_lineitem_ride(),
        F.when(F.col("l_linestatus") == "O", "green").otherwise("yellow").alias("color"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
    )
    return trips.withColumn("duration", duration_minutes("pickup_datetime", "dropoff_datetime"))


def raw_lineitem(spark: SparkSession, sf_dir: str, color: str) -> DataFrame:
    """The trips of one colour in its raw layout, as a monthly file would hold them."""
    pickup, dropoff = TIME_COLUMNS[color]
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return rows.filter(F.col("l_linestatus") == ("O" if color == "green" else "F")).select(
        F.col("l_shipdate").alias(pickup), (F.col("l_shipdate") + _lineitem_length()).alias(dropoff), *_lineitem_ride()
    )


def _lineitem_length() -> Column:
    return F.expr("INTERVAL '1' MINUTE") * (F.col("l_extendedprice") / F.lit(1000.0))


def _lineitem_ride() -> list[Column]:
    return [
        (F.col("l_suppkey") % ZONES + 1).alias("PULocationID"),
        (F.col("l_partkey") % ZONES + 1).alias("DOLocationID"),
        (F.col("l_quantity") / F.lit(2.0)).alias("trip_distance"),
    ]
