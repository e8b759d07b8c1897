import math
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import YELLOW_TIMES, raw_rides, trip, trips
from kerbside.functions import columns as c
from kerbside.operators import prepare, profile
from kerbside.sources import trips as source

NAN = float("nan")


def test_raw_fixture_rows(spark):
    # The rows and results every implementation of this preparation must agree on.
    done = prepare.prepare_raw(
        raw_rides(
            spark,
            (None, None, "2023-01-01 01:01:00", "2023-01-01 01:10:00"),
            (1.0, 1.0, "2023-01-01 01:02:00", "2023-01-01 01:10:00"),
            (1.0, None, "2023-01-01 01:02:00", "2023-01-01 01:02:59"),
            (3.0, 4.0, "2023-01-01 01:02:00", "2023-01-01 02:02:01"),
        ),
        "yellow",
    )
    printed = done.withColumns({t: F.col(t).cast("string") for t in YELLOW_TIMES})
    assert [tuple(r) for r in printed.collect()] == [
        ("-1", "-1", "2023-01-01 01:01:00", "2023-01-01 01:10:00", 9.0),
        ("1", "1", "2023-01-01 01:02:00", "2023-01-01 01:10:00", 8.0),
    ]
    assert dict(done.dtypes) == {
        "PULocationID": "string",
        "DOLocationID": "string",
        "tpep_pickup_datetime": "timestamp_ntz",
        "tpep_dropoff_datetime": "timestamp_ntz",
        "duration": "double",
    }


def test_bounds_are_inclusive_and_missing_times_are_dropped(spark):
    raw = raw_rides(
        spark,
        (1.0, 1.0, "2023-03-05 10:00:00", "2023-03-05 10:01:00"),
        (2.0, 1.0, "2023-03-05 10:00:00", "2023-03-05 11:00:00"),
        (3.0, 1.0, "2023-03-05 10:00:00", None),
        (4.0, 1.0, None, "2023-03-05 10:05:00"),
        (NAN, 1.0, "2023-03-05 10:00:00", "2023-03-05 10:30:00"),
    )
    done = prepare.prepare_raw(raw, "yellow").collect()
    assert [(r.PULocationID, r.duration) for r in done] == [("1", 1.0), ("2", 60.0), ("-1", 30.0)]


def test_unknown_colour(spark):
    raw = raw_rides(spark)
    for f in (prepare.prepare_raw, source.canonical):
        with pytest.raises(ValueError, match="colour"):
            f(raw, "purple")


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 4_000_000_000), min_size=1, max_size=40))
def test_interval_filter_equals_duration_filter(spark, micros):
    micros = micros + [59_999_999, 60_000_000, 60_000_001, 3_599_999_999, 3_600_000_000, 3_600_000_001]
    start = F.lit(datetime(2023, 3, 26, 1, 30)).cast("timestamp_ntz")
    table = spark.createDataFrame([(m,) for m in micros], "us BIGINT").select(
        "us", start.alias("pickup_datetime"), F.timestamp_add("MICROSECOND", F.col("us"), start).alias("dropoff_datetime")
    )
    timed = prepare.with_duration(table)
    expected = sorted(m for m in micros if 1 <= m / 1e6 / 60 <= 60)
    assert sorted(r.us for r in prepare.drop_outliers(timed).collect()) == expected
    assert sorted(r.us for r in timed.filter(c.in_bounds("duration")).collect()) == expected
    assert all(r.duration == r.us / 1e6 / 60 for r in timed.collect())


def test_duration_ignores_clock_changes(spark):
    """Zone-less times across a change to summer time differ by what they show."""
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        row = (datetime(2023, 3, 26, 1, 30), datetime(2023, 3, 26, 3, 0))
        table = spark.createDataFrame([row], "pickup_datetime TIMESTAMP_NTZ, dropoff_datetime TIMESTAMP_NTZ")
        assert prepare.with_duration(table).first().duration == 90.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_zone_code_is_total_and_idempotent(spark):
    values = [None, NAN, 1.0, 264.0, 0.0]
    table = spark.createDataFrame([(v,) for v in values], "z DOUBLE").select(c.zone_code("z").alias("z"), c.zone_text("z").alias("t"))
    assert [r.z for r in table.collect()] == ["-1", "-1", "1", "264", "0"]
    assert [r.t for r in table.collect()] == ["nan", "nan", "1.0", "264.0", "0.0"]
    assert [r.z for r in table.select(c.zone_code("z").alias("z")).collect()] == ["-1", "-1", "1", "264", "0"]


def test_nan_duration_is_no_accepted_length(spark):
    table = spark.createDataFrame([(NAN,), (None,), (5.0,)], "d DOUBLE")
    assert [r.d for r in table.filter(c.in_bounds("d")).collect()] == [5.0]
    r = profile.retention(table, "d").first()
    assert (r.n_rows, r.n_kept) == (3, 1) and math.isclose(r.retention_pct, 100 / 3)
    assert profile.missing_check(table, ["d"]).first().d_missing


def test_pair_and_ride_id(spark):
    row = spark.createDataFrame([(130, 205, 2023, 1, 17)], "p INT, d INT, y INT, m INT, i BIGINT")
    done = row.select(c.pair_key("p", "d").alias("k"), c.ride_id("y", "m", "i").alias("r")).first()
    assert (done.k, done.r) == ("130_205", "2023/01_17")


def test_next_month_and_paths(spark):
    assert source.following_month(2023, 12) == (2024, 1) and source.following_month(2023, 4) == (2023, 5)
    row = spark.createDataFrame([(2023, 12)], "y INT, m INT").select(c.next_month("y", "m").alias("d")).first()
    assert str(row.d) == "2024-01-01"
    assert source.month_path("green", 2023, 3, "/data/") == "/data/green_tripdata_2023-03.parquet"
    assert source.month_path("green", 2023, 3, pattern="x/{year}-{month}.pq") == "x/2023-3.pq"


def test_text_times_are_parsed(spark):
    raw = spark.createDataFrame(
        [(1, 2, "2023-01-01 10:00:00", "2023-01-01 10:12:30")],
        "PULocationID INT, DOLocationID INT, lpep_pickup_datetime STRING, lpep_dropoff_datetime STRING",
    )
    row = prepare.with_duration(source.canonical(raw, "green")).first()
    assert (row.duration, row.color, row.year, row.month, row.trip_distance) == (12.5, "green", 2023, 1, None)


def test_months_with_different_zone_types(spark, tmp_path):
    """Zones may be stored as integers in one month and as doubles with NaN in the next."""
    times = ("lpep_pickup_datetime", "lpep_dropoff_datetime")
    ints = raw_rides(spark, (1, 2, "2022-12-09 01:00:00", "2022-12-09 01:05:00"), zones="INT", times=times)
    doubles = raw_rides(spark, (NAN, 3.0, "2023-01-09 02:00:00", "2023-01-09 02:05:00"), times=times)
    for month, table in ((12, ints), (1, doubles)):
        year = 2022 if month == 12 else 2023
        table.coalesce(1).write.parquet(source.month_path("green", year, month, str(tmp_path)))
    both = source.read_months(spark, str(tmp_path), [("green", 2022, 12), ("green", 2023, 1)])
    found = sorted((r.year, r.month, r.PULocationID or -1, r.DOLocationID, r.source_row) for r in both.collect())
    assert found == [(2022, 12, 1, 2, 0), (2023, 1, -1, 3, 0)]

    source.write_canonical(both, f"{tmp_path}/lake")
    one = source.read_canonical(spark, f"{tmp_path}/lake").filter("year = 2023 and month = 1")
    assert [r.DOLocationID for r in one.collect()] == [3]
    assert "PartitionFilters: [isnotnull(year" in one._jdf.queryExecution().toString()


def test_profile_reports(spark):
    table = trips(spark, [trip(m) for m in (1, 2, 3, 30, 60, 90)])
    stats = profile.distribution(table, "duration").first()
    assert stats.n == 6 and math.isclose(stats.mean, 31.0) and stats.std_sample > stats.std_population
    counts = {r.bucket: r.n for r in profile.histogram(table, ["duration"], 0.0, 60.0, 2).collect()}
    assert counts == {0: 3, 1: 2, 2: 1}
    assert tuple(profile.shape(table).first()) == (6, 7)
    assert [r.duration for r in profile.preview(table, ["duration"], 2).collect()] == [1.0, 2.0]
    assert ("duration", "double") in profile.column_types(table)
    approx = profile.feature_count(table, ["PULocationID", "DOLocationID"], ["trip_distance"], exact=False).first()
    assert approx.n_features == profile.feature_count(table, ["PULocationID", "DOLocationID"], ["trip_distance"]).first().n_features == 3


def test_artifact_files(spark, tmp_path):
    (tmp_path / "a.pkl").write_bytes(b"12345")
    (tmp_path / "b.txt").write_bytes(b"1")
    found = profile.artifact_files(spark, str(tmp_path), ".pkl").collect()
    assert [(r.path.split("/")[-1], r.length) for r in found] == [("a.pkl", 5)]
