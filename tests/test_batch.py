"""A month of raw files, a trained and saved model, and a scored month, end to end."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kerbside.operators import registry, score
from kerbside.operators import train as models
from kerbside.operators.encode import PAIR_DISTANCE, ZONES
from kerbside.plans import batch, training
from kerbside.sources.trips import month_path, read_month

RAW = (
    "VendorID BIGINT, lpep_pickup_datetime TIMESTAMP_NTZ, lpep_dropoff_datetime TIMESTAMP_NTZ, "
    "PULocationID BIGINT, DOLocationID BIGINT, trip_distance DOUBLE, fare DOUBLE"
)


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("months"))
    for year, month in ((2022, 12), (2023, 1), (2023, 2)):
        rows = []
        for i in range(120):
            start = datetime(year, month, 1 + i % 28, i % 24)
            # The first row is dropped, so source and dense numbering differ.
            minutes = 0.5 if i == 0 else 100 if i % 40 == 7 else 5 + (i % 5) * 4 + (i % 3) * 2
            rows.append((1, start, start + timedelta(minutes=minutes), i % 5 or None, i % 3, float(i % 4), 9.5))
        spark.createDataFrame(rows, RAW).coalesce(1).write.parquet(month_path("green", year, month, folder))
    return folder


@pytest.fixture(scope="module")
def trained(spark, base, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("root"))
    return root, training.train_month(spark, base, root, "green", 2022, 12)


def test_training_validates_on_the_next_month(spark, trained):
    root, run_id = trained
    run = registry.read_runs(spark, f"{root}/runs").first()
    assert run.run_id == run_id and run.model_type == "LR" and run.params["columns"] == "8"
    assert run.metrics["train_rmse"] < 1e-6 and run.metrics["val_rmse"] == run.metrics["rmse"] < 1e-6


@pytest.mark.parametrize("numbering", ["source", "dense"])
def test_scored_month(spark, base, trained, tmp_path, numbering):
    root, run_id = trained
    path = models.model_location(run_id, root, experiment="trip-duration")
    summary = batch.score_months(spark, base, [("green", 2023, 1), ("green", 2023, 2)], path, str(tmp_path), numbering).first()
    # 120 rows per month less the short first and three long ones.
    assert summary.n == 2 * 116 and math.isclose(summary.mean, summary.total / summary.n)
    written = score.read_predictions(spark, str(tmp_path)).filter("month = 1").collect()
    positions = sorted(int(r.ride_id.split("_")[1]) for r in written)
    dropped = {0, 7, 47, 87}
    assert positions == ([i for i in range(120) if i not in dropped] if numbering == "source" else list(range(116)))
    assert {(r.taxi_type, r.year) for r in written} == {("green", 2023)}
    if numbering == "source":
        for r in written:
            i = int(r.ride_id.split("_")[1])
            assert r.ride_id.startswith("2023/01_") and math.isclose(r.predicted_duration, 5 + (i % 5) * 4 + (i % 3) * 2)


def test_rerun_replaces_its_months_only(spark, base, trained, tmp_path):
    root, run_id = trained
    path = models.model_location(run_id, root, experiment="trip-duration")
    for months in ([("green", 2023, 1)], [("green", 2023, 2)], [("green", 2023, 2)]):
        assert batch.score_months(spark, base, months, path, str(tmp_path)).first().n == 116
    assert score.read_predictions(spark, str(tmp_path)).count() == 232
    assert score.output_path("green", 2023, 2, "/out") == "/out/taxi_type=green/year=2023/month=02"


def test_scoring_is_one_stage_and_reads_few_columns(spark, base, trained):
    root, run_id = trained
    model = models.load(spark, models.model_location(run_id, root, experiment="trip-duration"))
    done = score.score_trips(model, read_month(spark, base, "green", 2023, 1))
    plan = done._jdf.queryExecution().executedPlan().toString()
    # The trips are never shuffled; only the effect tables (one row per zone) are sent around.
    assert plan.count("Exchange") == plan.count("BroadcastExchange") == 2 and "Python" not in plan
    assert "fare" not in plan and "VendorID" not in plan
    with pytest.raises(ValueError, match="numbering"):
        score.score_trips(model, read_month(spark, base, "green", 2023, 1), "none")


def test_prepared_feature_sets(spark, base, tmp_path):
    training.prepare_features(spark, base, str(tmp_path), "green", [(2022, 12), (2023, 1), (2023, 2)], PAIR_DISTANCE)
    sets = training.load_features(spark, str(tmp_path))
    assert {r.split: r.n for r in sets.groupBy("split").agg(F.sum("n").alias("n")).collect()} == {"train": 116, "val": 116, "test": 116}
    model = models.fit(sets.filter("split = 'train'"), PAIR_DISTANCE)
    assert set(models.metrics(model, sets)) == {"train_rmse", "val_rmse", "test_rmse"}


def test_model_by_alias(spark, base, trained):
    root, run_id = trained
    registry.set_alias(spark, f"{root}/aliases", "durations", "champion", run_id, "approved")
    model = batch.load_by_alias(spark, root, "trip-duration", "durations", "champion")
    assert model.spec == ZONES
    requests = spark.createDataFrame([(2, 1)], "PULocationID BIGINT, DOLocationID BIGINT")
    answer = score.score_requests(model, requests, run_id).first()
    assert math.isclose(answer.duration, 15.0) and answer.model_version == run_id


def test_empty_month(spark, base, trained):
    root, run_id = trained
    model = models.load(spark, models.model_location(run_id, root, experiment="trip-duration"))
    none = read_month(spark, base, "green", 2023, 1).filter("false")
    assert score.summary(score.score_trips(model, none)).first().n == 0


def test_ids_of_two_colours_and_several_files(spark, base, trained, tmp_path):
    """A month of three files, scored with another colour or alone: the same ids, each once."""
    root, run_id = trained
    path = models.model_location(run_id, root, experiment="trip-duration")
    for color in ("green", "yellow"):
        rows = spark.read.parquet(month_path("green", 2023, 1, base)).orderBy("lpep_pickup_datetime")
        names = {f"lpep_{x}": f"tpep_{x}" for x in ("pickup_datetime", "dropoff_datetime")} if color == "yellow" else {}
        rows.withColumnsRenamed(names).repartitionByRange(3, rows.columns[1]).write.parquet(month_path(color, 2023, 1, str(tmp_path / "in")))
    ids = {}
    for colors in (("green",), ("yellow",), ("green", "yellow")):
        out = str(tmp_path / "-".join(colors))
        batch.score_months(spark, str(tmp_path / "in"), [(c, 2023, 1) for c in colors], path, out)
        written = score.read_predictions(spark, out).collect()
        ids[colors] = {c: sorted(r.ride_id for r in written if r.taxi_type == c) for c in colors}
        assert all(len(set(x)) == len(x) == 116 for x in ids[colors].values())
    assert ids["green", "yellow"] == {**ids["green",], **ids["yellow",]}
