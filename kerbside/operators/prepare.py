"""Derive the duration, drop outliers, normalise zones. Narrow steps only: no shuffle, no UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.columns import ZONE_COLUMNS, as_timestamp, duration_minutes, month_split, trip_in_bounds, trip_interval, zone_code
from kerbside.sources.trips import TIME_COLUMNS



def with_interval(trips: DataFrame, pickup: str = "pickup_datetime", dropoff: str = "dropoff_datetime") -> DataFrame:
    return trips.withColumn("duration_td", trip_interval(pickup, dropoff))


def with_duration(trips: DataFrame, pickup: str = "pickup_datetime", dropoff: str = "dropoff_datetime") -> DataFrame:
    return trips.withColumn("duration", duration_minutes(pickup, dropoff))


def drop_outliers(trips: DataFrame, pickup: str = "pickup_datetime", dropoff: str = "dropoff_datetime") -> DataFrame:
    """Keep trips of an accepted length. The test is fused into the scan stage."""
    return trips.filter(trip_in_bounds(pickup, dropoff))


def with_zone_codes(trips: DataFrame, zones: Sequence[str] = ZONE_COLUMNS) -> DataFrame:
    return trips.withColumns({z: zone_code(z) for z in zones})


def prepare(trips: DataFrame, zones: Sequence[str] = ZONE_COLUMNS) -> DataFrame:
    """Canonical trips to trips ready for features: duration, accepted rows, zones as text."""
    return with_zone_codes(with_duration(drop_outliers(trips)), zones)


def prepare_raw(raw: DataFrame, color: str, zones: Sequence[str] = ZONE_COLUMNS) -> DataFrame:
    """`prepare` on a colour's raw layout, keeping its own column names."""
    if color not in TIME_COLUMNS:
        raise ValueError(f"unknown trip colour {color!r}; known: {sorted(TIME_COLUMNS)}")
    pickup, dropoff = TIME_COLUMNS[color]
    timed = raw.withColumns({c: as_timestamp(c) for c in (pickup, dropoff)})
    return with_zone_codes(with_duration(drop_outliers(timed, pickup, dropoff), pickup, dropoff), zones)


def with_month_split(trips: DataFrame, train, val, test) -> DataFrame:
    """Mark three months (each a `(year, month)`) as train, val and test and drop all others.

    The filter is on the partition columns, so a canonical table is read for these months only.
    """
    months = [train, val, test]
    chosen = F.lit(False)
    for year, month in months:
        chosen = chosen | ((F.col("year") == year) & (F.col("month") == month))
    period = F.col("year") * 100 + F.col("month")
    return trips.filter(chosen).withColumn("split", month_split(period, *[y * 100 + m for y, m in months]))


def features_and_label(trips: DataFrame, columns: Sequence[str], label: str = "duration") -> DataFrame:
    return trips.select(*columns, F.col(label).alias("label"))
