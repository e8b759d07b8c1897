import math
import re
from functools import partial

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from helpers import random_rides, trip, trips
from kerbside.operators import conjugate, encode, grow, linear, pair_ols, search, trees
from kerbside.operators import train as models
from kerbside.operators.cells import LABEL, SPREAD, WEIGHT, collapse, edges, uncollapsed
from kerbside.operators.encode import PAIR_DISTANCE, ZONES, ZONES_DISTANCE, FeatureSpec
from kerbside.plans import training
from kerbside.plans.batch import load_by_alias
from kerbside.operators import registry

SPECS = [ZONES, ZONES_DISTANCE, PAIR_DISTANCE, FeatureSpec(("PULocationID",)), FeatureSpec((), ("trip_distance",))]


@pytest.fixture(scope="module")
def rides(spark):
    return trips(spark, random_rides(600)).cache()


def design(rows, spec, names):
    """One-hot matrix by hand."""
    index = {n: i for i, n in enumerate(names)}
    x = np.zeros((len(rows), len(names)))
    code = lambda v: "-1" if v is None else str(int(v))
    for i, r in enumerate(rows):
        for c in spec.categorical:
            value = f"{code(r.PULocationID)}_{code(r.DOLocationID)}" if c == "PU_DO" else code(r[c])
            if f"{c}={value}" in index:
                x[i, index[f"{c}={value}"]] = 1.0
        for n in spec.numerical:
            x[i, index[n]] = r[n]
    return x


def least_norm(x, y):
    """Least squares of least norm after centring, with an unpenalised intercept."""
    w = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=None)[0]
    return w, y.mean() - x.mean(0) @ w


@pytest.mark.parametrize("spec", SPECS, ids=lambda s: "+".join(s.categorical + s.numerical))
def test_linear_equals_brute_force_on_rows(spark, rides, spec):
    """Weights, intercept and predictions, for unseen zones as well."""
    cells = collapse(rides, spec)
    train = cells.filter("split = 'train'")
    model = models.fit(train, spec, "LR")
    weights = model.pipeline.weights()
    names = list(weights)

    rows = rides.filter("split = 'train'").collect()
    w, b = least_norm(design(rows, spec, names), np.array([r.duration for r in rows]))
    assert np.allclose(list(weights.values()), w, atol=1e-6)
    assert math.isclose(model.intercept, b, abs_tol=1e-6)

    others = trips(spark, [trip(5, 99, 98), trip(5, 2, 98), trip(5, 99, 1), trip(5, None, 3)]).union(rides.filter("split = 'test'"))
    found = models.predict(model, others).collect()
    assert np.allclose([r.prediction for r in found], design(found, spec, names) @ w + b, atol=1e-6)


@pytest.mark.parametrize("spec", [ZONES, ZONES_DISTANCE, PAIR_DISTANCE], ids=lambda s: "+".join(s.categorical + s.numerical))
def test_the_width_does_not_change_the_answer(rides, monkeypatch, spec):
    """Beyond the normal equations, and with effects in the shared folder: also for unseen zones."""
    train = collapse(rides, spec).filter("split = 'train'")
    narrow = models.fit(train, spec)
    monkeypatch.setattr(linear, "MAX_NORMAL_COLUMNS", 3)
    monkeypatch.setattr(linear, "MAX_BROADCAST", 2)
    monkeypatch.setattr(linear, "MAX_HELD", 2)
    wide = models.fit(train, spec)
    assert narrow.pipeline.weights() == pytest.approx(wide.pipeline.weights(), abs=1e-5)
    assert math.isclose(narrow.intercept, wide.intercept, abs_tol=1e-5)
    unseen = rides.withColumn("PULocationID", F.lit(77)).select(*rides.columns)
    a, b = ([r.prediction for r in models.predict(m, unseen).orderBy("duration", "DOLocationID").collect()] for m in (narrow, wide))
    assert np.allclose(a, b, atol=1e-5)


@pytest.mark.parametrize("spec", [ZONES, ZONES_DISTANCE], ids=["zones", "zones+distance"])
@pytest.mark.parametrize("columns", [4096, 3])
def test_zone_islands(spark, monkeypatch, spec, columns):
    """Zones in three groups without a trip between them: least norm decides what crosses them."""
    monkeypatch.setattr(linear, "MAX_NORMAL_COLUMNS", columns)
    rng = np.random.default_rng(4)
    groups = [((1, 2), (3,)), ((4, 5, 6), (7, 8)), ((10,), (11, 12))]
    rows = [trip(5 + 20 * g + 2 * pu - do + 1.5 * d + rng.normal(), pu, do, d) for g, (a, b) in enumerate(groups) for pu in a for do in b for d in (1.0, 2.0, 3.5)]
    table = trips(spark, rows)
    model = models.fit(collapse(table, spec), spec)
    weights = model.pipeline.weights()
    found = table.collect()
    w, intercept = least_norm(design(found, spec, list(weights)), np.array([r.duration for r in found]))
    assert np.allclose(list(weights.values()), w, atol=1e-4) and math.isclose(model.intercept, intercept, abs_tol=1e-4)


@pytest.mark.parametrize("spec", [ZONES, ZONES_DISTANCE, FeatureSpec(("PULocationID",), ("trip_distance", "passengers"))], ids=["zones", "zones+distance", "two numbers"])
def test_conjugate_gradients_equal_brute_force(rides, spec):
    table = rides.withColumn("passengers", F.pmod(F.xxhash64("duration"), F.lit(5)).cast("double")).filter("split = 'train'")
    found = conjugate.solve(uncollapsed(table, spec), spec, WEIGHT, LABEL)
    names = [f"{c}={r.key}" for c, e in found.effects.items() for r in e.orderBy("key").collect()] + list(spec.numerical)
    values = [r.effect for e in found.effects.values() for r in e.orderBy("key").collect()] + [found.slopes[n] for n in spec.numerical]
    rows = table.collect()
    w, b = least_norm(design(rows, spec, names), np.array([r.duration for r in rows]))
    assert np.allclose(values, w, atol=1e-7) and math.isclose(found.intercept, b, abs_tol=1e-7)


def test_conjugate_gradients_without_variation(spark):
    """A number that never varies has no slope; one zone alone has no effect."""
    table = trips(spark, [trip(5, 1, 1, 2.0), trip(7, 1, 2, 2.0), trip(9, 1, 2, 2.0)])
    found = conjugate.solve(uncollapsed(table, ZONES_DISTANCE), ZONES_DISTANCE, WEIGHT, LABEL)
    assert found.slopes == {"trip_distance": 0.0}
    effects = {c: {r.key: r.effect for r in e.collect()} for c, e in found.effects.items()}
    assert effects["PULocationID"] == pytest.approx({"1": 0.0}, abs=1e-9) and effects["DOLocationID"] == pytest.approx({"1": -1.5, "2": 1.5})
    assert found.intercept == pytest.approx(6.5)


def test_two_hundred_thousand_zones_stay_tables(spark, monkeypatch):
    """No category passes through the driver: what is collected are sums."""
    n = 200_000  # three trips each, and 101 zones on the other side
    rows = spark.range(3 * n).select(
        (F.col("id") % n).alias("PULocationID"), F.pmod(F.xxhash64("id"), F.lit(101)).alias("DOLocationID"), F.lit(1.0).alias(WEIGHT), F.lit("train").alias("split"),
    ).withColumn(LABEL, 10.0 + F.col("PULocationID") % 13 + 0.5 * F.col("DOLocationID"))
    collected = []
    real = type(rows).collect
    monkeypatch.setattr(type(rows), "collect", lambda self: collected.append(real(self)) or collected[-1])
    model = models.fit(rows, ZONES)
    assert max(map(len, collected)) <= 200 and model.pipeline.sizes == {"DOLocationID": 101, "PULocationID": n}
    wrong = models.predict(model, rows).filter(F.abs(F.col("prediction") - F.col(LABEL)) > 1e-6)
    assert wrong.count() == 0


def test_vocabulary_is_frozen(rides):
    train = rides.filter("split = 'train'")
    model = encode.fit_encoder(train, PAIR_DISTANCE)
    names = encode.feature_names(model, PAIR_DISTANCE)
    assert [tuple(r) for r in encode.vocabulary(train, PAIR_DISTANCE).orderBy("index").collect()] == [
        (n, i) for i, n in enumerate(names)
    ]
    rows = rides.filter("split != 'train'").collect()
    expected = design(rows, PAIR_DISTANCE, names)
    found = model.transform(rides.filter("split != 'train'")).select("features").collect()
    assert np.array_equal(np.array([r.features.toArray() for r in found]), expected)


def test_missing_numbers(spark):
    table = trips(spark, [trip(5, distance=None), trip(6)])
    encoder = encode.fit_encoder(trips(spark, [trip(5), trip(6)]), ZONES_DISTANCE)
    with pytest.raises(Exception, match="null"):
        encoder.transform(table).select("features").collect()
    for spec in (PAIR_DISTANCE, ZONES_DISTANCE):
        with pytest.raises(Exception, match="null|missing"):
            models.fit(collapse(table, spec), spec)
    fitted = models.fit(collapse(trips(spark, [trip(5), trip(6, 3, 4, 2.0)]), ZONES_DISTANCE), ZONES_DISTANCE)
    with pytest.raises(Exception, match="trip_distance is missing"):
        models.predict(fitted, table).collect()
    keep = encode.fit_encoder(trips(spark, [trip(5)]), ZONES_DISTANCE, on_missing="keep")
    assert any(np.isnan(r.features.toArray()).any() for r in keep.transform(table).select("features").collect())


def test_cells_carry_all_that_rows_do(rides):
    cells, rows = collapse(rides, ZONES), uncollapsed(rides, ZONES)
    assert cells.agg(F.sum(WEIGHT)).first()[0] == 600 and rows.count() == 600
    from_cells = models.fit(cells.filter("split = 'train'"), ZONES)
    from_rows = models.fit(rows.filter("split = 'train'"), ZONES)
    assert from_cells.pipeline.weights() == pytest.approx(from_rows.pipeline.weights(), abs=1e-6)

    scored = models.predict(from_cells, rides)
    direct = {r.split: r.rmse for r in models.row_rmse(scored, by=["split"]).collect()}
    for data in (cells, rows):
        assert models.metrics(from_cells, data) == pytest.approx({f"{k}_rmse": v for k, v in direct.items()})
    spread = cells.agg(F.sum(SPREAD)).first()[0]
    assert spread > 0 and rows.agg(F.sum(SPREAD)).first()[0] == 0


def test_boosting_on_cells_equals_boosting_on_rows(rides):
    """Split gains depend on a cell only through its weight and mean."""
    params = {"num_boost_round": 5, "max_depth": 3, "min_child_weight": 1}
    train = [f(rides, ZONES).filter("split = 'train'") for f in (collapse, uncollapsed)]
    a, b = (models.predict(models.fit(t, ZONES, "XGB", params), rides).orderBy("duration") for t in train)
    assert np.allclose([r.prediction for r in a.collect()], [r.prediction for r in b.collect()], atol=1e-6)


@pytest.mark.parametrize("model_type", ["RF", "XGB"])
def test_trees_learn_and_handle_unseen_zones(spark, rides, model_type):
    cells = collapse(rides, ZONES_DISTANCE)
    train, val = (cells.filter(F.col("split") == s) for s in ("train", "val"))
    params = {"n_estimators": 10, "max_depth": 5} if model_type == "RF" else {"num_boost_round": 20, "max_depth": 3}
    model = models.fit(train, ZONES_DISTANCE, model_type, params, val if model_type == "XGB" else None)
    scores = models.metrics(model, cells)
    spread = rides.agg(F.stddev_pop("duration")).first()[0]
    assert scores["train_rmse"] < 0.6 * spread and scores["val_rmse"] < 0.7 * spread
    assert models.predict(model, trips(spark, [trip(5, 99, 98)])).first().prediction > 0


@pytest.mark.parametrize("model_type", ["LR", "RF"])
def test_combinations_get_the_same_answers(rides, model_type):
    model = models.fit(collapse(rides, ZONES_DISTANCE).filter("split = 'train'"), ZONES_DISTANCE, model_type, {"n_estimators": 3, "max_depth": 4} if model_type == "RF" else None)
    both = models.predict_combinations(model, models.predict(model, rides).withColumnRenamed("prediction", "direct"), ZONES_DISTANCE)
    assert both.count() == 600 and both.filter("abs(direct - prediction) > 1e-9 or prediction is null").count() == 0


def test_pairs_of_trees_become_two_zones(rides):
    cells = collapse(rides, PAIR_DISTANCE).filter("split = 'train'")
    model = models.fit(cells, PAIR_DISTANCE, "RF", {"n_estimators": 3, "max_depth": 4})
    assert model.regressor.numFeatures == 3


def test_arguments_are_checked(rides, spark):
    cells = collapse(rides, ZONES)
    with pytest.raises(ValueError, match="LR"):
        models.fit(cells, ZONES, "SVM")
    with pytest.raises(ValueError, match="depth"):
        models.fit(cells, ZONES, "XGB", {"max_depth": 31})
    with pytest.raises(ValueError, match="model type"):
        training.train_month(spark, "/nowhere", "/nowhere", "green", 2023, 1, "SVM")


def test_save_and_load(spark, rides, tmp_path):
    model = models.fit(collapse(rides, PAIR_DISTANCE).filter("split = 'train'"), PAIR_DISTANCE)
    models.save(model, f"{tmp_path}/m")
    again = models.load(spark, f"{tmp_path}/m")
    assert again.spec == PAIR_DISTANCE and again.model_type == "LR" and again.intercept == model.intercept
    a, b = (models.predict(m, rides).orderBy("duration").select("prediction").collect() for m in (model, again))
    assert a == b
    assert models.model_location("r1", "/root/", None) == "/root/1/r1" and models.model_location("r1", "/root", "/x") == "/x"


def test_requests_with_numbers_and_text_score_alike(spark, rides):
    """Integers, doubles and text name the same zone; different rides may differ."""
    model = models.fit(collapse(rides, ZONES).filter("split = 'train'"), ZONES)
    ask = lambda t: [r.prediction for r in models.predict(model, spark.createDataFrame([("2", "1"), ("4", "3")], "PULocationID STRING, DOLocationID STRING").selectExpr(f"cast(PULocationID as {t}) PULocationID", f"cast(DOLocationID as {t}) DOLocationID")).collect()]
    assert ask("bigint") == ask("double") == ask("string")
    assert ask("bigint")[0] != ask("bigint")[1]


def test_pair_ols_without_variation(spark):
    rows = trips(spark, [trip(5, 1, 1, 2.0), trip(7, 1, 1, 2.0), trip(9, 2, 2, 3.0)])
    cells = collapse(rows, PAIR_DISTANCE)
    model = pair_ols.fit(cells, ["PULocationID", "DOLocationID"], "trip_distance", LABEL, WEIGHT)
    assert model.slope == 0.0 and model.intercept == 7.5


def test_trials_are_seeded_and_in_range(spark):
    a, b = (search.trials(spark).collect() for _ in range(2))
    assert a == b and len(a) == search.TRIALS
    for name, (low, high, _) in search.FOREST_SPACE.items():
        assert all(low <= r[name] <= high for r in a)
    assert len({r.max_depth for r in a}) > 3


def test_search_orders_by_loss(spark):
    found = search.search(lambda p: abs(p["max_depth"] - 7), search.trials(spark))
    assert [x for _, x in found] == sorted(x for _, x in found)


def test_search_and_register(spark, rides, tmp_path):
    cells = collapse(rides, ZONES_DISTANCE).cache()
    space = {"max_depth": (2, 5, 1), "n_estimators": (3, 5, 1), "min_samples_leaf": (1, 4, 1)}
    best = training.search_and_register(spark, cells, str(tmp_path), n_trials=3, top_n=2, space=space).collect()
    assert sorted(r.alias for r in best) == ["challenger", "champion"]
    runs = registry.read_runs(spark, f"{tmp_path}/runs")
    assert runs.filter("experiment = 'search'").count() == 3 and runs.filter("experiment = 'best'").count() == 2
    champion = next(r for r in best if r.alias == "champion")
    assert champion.score == min(r.metrics["test_rmse"] for r in runs.filter("experiment = 'best'").collect())
    again = models.load(spark, models.model_location(champion.run_id, str(tmp_path), experiment="best"))
    assert models.metrics(again, cells)["test_rmse"] == pytest.approx(champion.score)
    named = load_by_alias(spark, str(tmp_path), "best", "best", "champion")
    assert models.metrics(named, cells)["test_rmse"] == pytest.approx(champion.score)


@pytest.mark.parametrize("distance", [0.1, 1.1, 3.66, 2.0])
def test_pair_ols_finds_no_slope_where_nothing_varies(spark, distance):
    rows = trips(spark, [trip(m, m % 3, 1, distance + m % 3) for m in range(5, 40)])
    for cells in (collapse(rows, PAIR_DISTANCE), uncollapsed(rows, PAIR_DISTANCE)):
        assert pair_ols.fit(cells, ["PULocationID", "DOLocationID"], "trip_distance", LABEL, WEIGHT).slope == 0.0


def test_pair_ols_keeps_digits_next_to_outliers(spark):
    rows = trips(spark, [trip(5 + k % 7 + 0.25 * (k % 4), k % 2, 1, (k % 2) * 1e5 + k % 4 / 100) for k in range(56)])
    model = pair_ols.fit(uncollapsed(rows, PAIR_DISTANCE), ["PULocationID", "DOLocationID"], "trip_distance", LABEL, WEIGHT)
    table = rows.collect()
    x, y = np.array([r.trip_distance for r in table]), np.array([r.duration for r in table])
    zone = np.array([r.PULocationID for r in table])
    dx, dy = (v - np.array([v[zone == z].mean() for z in zone]) for v in (x, y))
    assert model.slope == pytest.approx((dx @ dy) / (dx @ dx), rel=1e-9)


@pytest.mark.parametrize("model_type", ["RF", "XGB"])
def test_trees_on_one_zone_feature(spark, rides, model_type):
    """As many cells as categories, and few of them."""
    spec = FeatureSpec(("PULocationID",))
    params = {"max_depth": 3, **({"n_estimators": 3} if model_type == "RF" else {"num_boost_round": 3})}
    model = models.fit(collapse(rides, spec).filter("split = 'train'"), spec, model_type, params)
    assert models.predict(model, rides).filter("prediction IS NULL").count() == 0


def test_rows_of_trees_have_as_many_partitions_as_they_fill(spark, rides):
    """However many the shuffle of the cells left: each partition sends the bins of every open node of a fit."""
    cells = collapse(rides, ZONES_DISTANCE).filter("split = 'train'")
    encoder, bins = models._tree_encoder(cells, ZONES_DISTANCE)
    rows, trips_ = models._tree_rows(cells.repartition(60), encoder, bins)
    assert rows.rdd.getNumPartitions() == 1 and rows.agg(F.sum(WEIGHT)).first()[0] == pytest.approx(trips_)
    assert "Scan ExistingRDD" in rows._jdf.queryExecution().executedPlan().toString()
    many = spark.range(40_000).select((F.col("id") % 200).alias("PULocationID"), F.lit(1).alias("DOLocationID"), F.col("id").cast("double").alias("trip_distance"), F.lit(1.0).alias(WEIGHT), F.lit(2.0).alias(LABEL))
    wide = models._tree_rows(many.repartition(60), *models._tree_encoder(many, ZONES_DISTANCE))[0]
    assert wide.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and wide.count() >= 40_000


def test_boosting_keeps_no_trees_in_the_plan_of_a_round(rides, monkeypatch):
    """Every round starts from a checkpoint: what its tasks are sent does not grow with the trees before."""
    asked, real = {}, models.GBTRegressor
    monkeypatch.setattr(models, "GBTRegressor", lambda **k: asked.update(k) or real(**k))
    models.fit(collapse(rides, ZONES).filter("split = 'train'"), ZONES, "XGB", {"num_boost_round": 2, "max_depth": 3})
    assert asked["checkpointInterval"] == 1


def test_bagging_draws_trips_not_cells(spark):
    """Two cells of equal weight: the roots of row-wise bags stay near the mean."""
    cells = spark.createDataFrame([(1, 10.0, 1e6, 0.0), (2, 20.0, 1e6, 0.0)], f"PULocationID BIGINT, {LABEL} DOUBLE, {WEIGHT} DOUBLE, {SPREAD} DOUBLE")
    forest = models.fit(cells, FeatureSpec(("PULocationID",)), "RF", {"max_depth": 0, "n_estimators": 20})
    roots = [t.predict(Vectors.dense(0.0)) for t in forest.regressor.trees]
    assert all(abs(r - 15) < 0.5 for r in roots)


def test_patience(rides):
    assert models._best_round([5, 4, 3, 3, 3], 2) == 3 and models._best_round([5, 4, 3, 2, 1], 1) is None
    assert models._best_round([5, 4, 4.5, 4.4, 3], 2) == 2 and models._best_round([5, 4, 4.5, 4.4, 3], 3) is None
    cells = collapse(rides, ZONES)
    train, val = (cells.filter(F.col("split") == s) for s in ("train", "val"))
    params = {"num_boost_round": 12, "max_depth": 3, "learning_rate": 0.8}
    kept = {p: models.fit(train, ZONES, "XGB", {**params, "early_stopping_rounds": p}, val).regressor.getNumTrees for p in (2, 12, 50)}
    assert kept[12] == kept[50] == 12 and kept[2] <= 12


def test_a_shortened_model_is_that_of_fewer_rounds(spark, rides, tmp_path):
    train = collapse(rides, ZONES).filter("split = 'train'")
    long, short = (models.fit(train, ZONES, "XGB", {"num_boost_round": n, "max_depth": 3}) for n in (6, 2))
    cut = trees.shortened(long.regressor, 2)
    assert cut.getNumTrees == 2 and cut.treeWeights == short.regressor.treeWeights
    long.pipeline = PipelineModel([*long.pipeline.stages[:-1], cut])
    a, b = ([r.prediction for r in models.predict(m, rides).orderBy("duration").collect()] for m in (long, short))
    assert a == b
    models.save(long, f"{tmp_path}/m")
    assert models.load(spark, f"{tmp_path}/m").regressor.getNumTrees == 2


def test_small_nodes_are_not_split(rides):
    """Trips of a node count, and the answers are those of the nodes that stay."""
    train = collapse(rides, ZONES_DISTANCE).filter("split = 'train'")
    fit = lambda n: models.fit(train, ZONES_DISTANCE, "RF", {"n_estimators": 3, "max_depth": 6, "min_samples_split": n})
    sizes = {n: [t.numNodes for t in fit(n).regressor.trees] for n in (2, 20, 60, 10_000)}
    assert all(a > b > c > d == 1 for a, b, c, d in zip(*(sizes[n] for n in (2, 20, 60, 10_000)), strict=True))
    with_limit = models.predict(fit(10_000), rides).select("prediction").distinct().collect()
    assert len(with_limit) == 1


@pytest.mark.parametrize("together", [grow.TOGETHER, 40])
def test_deep_forests_are_grown_to_the_nodes_of_a_spark_fit(spark, rides, tmp_path, monkeypatch, together):
    """Whether nodes are split by sums or where their rows meet. No node weighs exactly what a limit says: there
    rounding decides in Spark."""
    train = collapse(rides, ZONES_DISTANCE).filter("split = 'train'").withColumn(WEIGHT, F.col(WEIGHT) * 1.37)
    params = {"n_estimators": 2, "bootstrap": False, "max_depth": 9, "min_samples_leaf": 2, "min_samples_split": 6}
    of_spark = models.fit(train, ZONES_DISTANCE, "RF", params)
    monkeypatch.setattr(models, "SPARK_LEAVES", 0)
    monkeypatch.setattr(grow, "grown", partial(grow.grown, together=together))
    own = models.fit(train, ZONES_DISTANCE, "RF", params)
    assert [t.numNodes for t in own.regressor.trees] == [t.numNodes for t in of_spark.regressor.trees]
    assert own.regressor.trees[1].depth == of_spark.regressor.trees[1].depth and own.regressor.getMaxDepth() == 9
    a, b = ([r.prediction for r in models.predict(m, train).orderBy(*ZONES_DISTANCE.inputs).collect()] for m in (own, of_spark))
    assert a == pytest.approx(b)
    models.save(own, f"{tmp_path}/m")
    assert models.metrics(models.load(spark, f"{tmp_path}/m"), train) == pytest.approx(models.metrics(own, train))


@pytest.mark.parametrize(("together", "kept"), [(grow.ALONE, grow.KEPT), (40, 2)])
def test_deep_boosting_is_grown_to_the_trees_of_a_spark_fit(spark, rides, tmp_path, monkeypatch, together, kept):
    train = collapse(rides, ZONES_DISTANCE).filter("split = 'train'").withColumn(WEIGHT, F.col(WEIGHT) * 1.37)
    params = {"num_boost_round": 4, "max_depth": 6, "min_child_weight": 3, "learning_rate": 0.3}
    of_spark = models.fit(train, ZONES_DISTANCE, "XGB", params)
    asked, real = [], models.GBTRegressor

    class Seen(real):
        def _fit(self, rows):
            asked.append((self.getMaxDepth(), self.getMaxIter()))
            return super()._fit(rows)

    monkeypatch.setattr(models, "GBTRegressor", Seen)
    monkeypatch.setattr(models, "SPARK_LEVELS", 0)
    monkeypatch.setattr(grow, "boosted", partial(grow.boosted, together=together, kept=kept))
    own = models.fit(train, ZONES_DISTANCE, "XGB", params)
    assert asked == [(0, 2)] and own.regressor.treeWeights == of_spark.regressor.treeWeights == [1, 0.3, 0.3, 0.3]
    assert [t.numNodes for t in own.regressor.trees] == [t.numNodes for t in of_spark.regressor.trees]
    assert own.regressor.getMaxDepth() == 6 and own.regressor.getMaxIter() == 4
    a, b = ([r.prediction for r in models.predict(m, train).orderBy(*ZONES_DISTANCE.inputs).collect()] for m in (own, of_spark))
    assert a == pytest.approx(b)
    models.save(own, f"{tmp_path}/m")
    assert models.metrics(models.load(spark, f"{tmp_path}/m"), train) == pytest.approx(models.metrics(own, train))
    one = models.fit(train, ZONES_DISTANCE, "XGB", {**params, "num_boost_round": 1}).regressor
    assert one.treeWeights == [1] and one.trees[0].numNodes == own.regressor.trees[0].numNodes


def test_rows_are_answered_as_by_their_leaves(spark):
    """Categories, numbers and bins that a node has not seen."""
    rows = [(0, 1, 6.0, 12.0, 30.0, 6, 0, [1.0, 2.0], 1.0), (0, 2, 4.0, 4.0, 5.0, 4, 1, [2.5], 1.0), (0, 3, 2.0, 8.0, 33.0, 2, -1, [], -1.0)]
    rows += [(0, 4, 3.0, 1.5, 2.0, 3, -1, [], -1.0), (0, 5, 1.0, 2.5, 7.0, 1, -1, [], -1.0)]
    tree = grow._walk(spark.createDataFrame(rows, grow.NODES).toArrow(), [[], [1.5, 2.5, 7.0]], [4, 0])
    assert grow._answers(tree, np.array([[0, 1, 2, 3, 1, 2], [0, 0, 1, 1, 2, 3]])).tolist() == [4, 0.5, 0.5, 4, 2.5, 2.5]


def test_grown_forests_do_not_depend_on_partitions_and_bag_as_poisson(spark, rides, monkeypatch):
    monkeypatch.setattr(models, "SPARK_LEAVES", 0)
    train = collapse(rides, ZONES_DISTANCE).filter("split = 'train'")
    params = {"n_estimators": 4, "max_depth": 8}
    a, b = (models.fit(cells, ZONES_DISTANCE, "RF", params) for cells in (train, train.repartition(30)))
    sizes = [t.numNodes for t in a.regressor.trees]
    assert sizes == [t.numNodes for t in b.regressor.trees] and len(set(sizes)) > 1
    assert models.metrics(a, train) == pytest.approx(models.metrics(b, train))
    k = [r[0] for r in spark.range(20_000).select(grow._drawn(F.xxhash64("id", F.lit(42)))).collect()]
    assert np.mean(k) == pytest.approx(1, abs=0.03) and np.var(k) == pytest.approx(1, abs=0.05)


def test_a_search_fits_no_deep_forest_by_dense_bins(rides, monkeypatch):
    """Spark's fit, which searches all bins of every node, is asked for the roots alone."""
    asked, real = [], models.RandomForestRegressor
    monkeypatch.setattr(models, "SPARK_LEAVES", 100)

    class Seen(real):
        def _fit(self, rows):
            asked.append(self.getMaxDepth())
            return super()._fit(rows)

    monkeypatch.setattr(models, "RandomForestRegressor", Seen)
    cells = collapse(rides, ZONES_DISTANCE)
    loss = search.forest_objective(cells, ZONES_DISTANCE)
    assert loss({"trial": 0, "max_depth": 20, "n_estimators": 10}) > 0 and loss({"max_depth": 2, "n_estimators": 3}) > 0
    assert asked == [0, 2]


def test_trials_of_a_search_share_the_rows_of_trees(rides, monkeypatch):
    made, real = [], models._tree_rows
    monkeypatch.setattr(models, "_tree_rows", lambda *a: made.append(a) or real(*a))
    cells = collapse(rides, ZONES_DISTANCE)
    loss = search.forest_objective(cells, ZONES_DISTANCE)
    losses = [loss({"max_depth": d, "n_estimators": 3}) for d in (1, 5)]
    assert len(made) == 1 and losses[0] != losses[1]
    alone = models.fit(cells.filter("split = 'train'"), ZONES_DISTANCE, "RF", {"max_depth": 1, "n_estimators": 1, "bootstrap": False})
    assert loss({"max_depth": 1, "n_estimators": 1, "bootstrap": False}) == pytest.approx(models.metrics(alone, cells)["val_rmse"])


def test_rows_of_grown_trees_are_binned_once(spark):
    """Number bins count the limits below a value; categories are their own bins; later jobs read a table."""
    rows = spark.createDataFrame([(Vectors.dense(2, x), 1.0, 3.0, 1) for x in (-1.0, 1.5, 1.6, 9.0)], ["features", WEIGHT, LABEL, "part"])
    binned = grow._binned(rows, [[], [1.5, 2.5]], [4, 0])
    assert [r.bins for r in binned.collect()] == [[2, 0], [2, 0], [2, 1], [2, 2]] and len({r.own for r in binned.collect()}) == 4
    assert "MapInArrow" not in binned._jdf.queryExecution().executedPlan().toString()


def test_thresholds_of_boosted_trees_are_those_of_a_spark_fit(spark, monkeypatch):
    """Weights count, zeros too; numbers of very many values are cut at quantiles."""
    data = [(Vectors.dense(round((k * 7919 % 1009) ** 1.5 / 50 - 3, 3) if k % 9 else 0.0), 0.5 + k % 4, float(k * 31 % 101), 1) for k in range(1500)]
    rows = spark.createDataFrame(data, ["features", WEIGHT, LABEL, "part"])
    deep = models.RandomForestRegressor(labelCol=LABEL, weightCol=WEIGHT, numTrees=1, featureSubsetStrategy="all", bootstrap=False, maxBins=40, maxDepth=14).fit(rows)
    used = {float(x) for x in re.findall(r"feature 0 <= ([-0-9.E]+)", deep.trees[0].toDebugString)}
    (found,) = grow.strides(rows, [0], 40)
    assert len(found) >= 38 and used <= set(found) and len(used) > 30
    monkeypatch.setattr(grow, "VALUES", 100)
    assert grow.strides(rows, [0], 40) == grow.cuts(rows, [0], 40)


def test_parameters_are_checked_and_recorded(rides):
    cells = collapse(rides, PAIR_DISTANCE).filter("split = 'train'")
    with pytest.raises(ValueError, match="max_dept"):
        models.fit(cells, PAIR_DISTANCE, "RF", {"max_dept": 3})
    model = models.fit(cells, PAIR_DISTANCE, "RF", {"max_depth": 2, "n_estimators": 2, "n_jobs": 2})
    assert model.params["without_effect"] == "n_jobs" and model.params["pair_as"] == "two zones"
    lone = models.fit(cells, PAIR_DISTANCE, "RF", {"max_depth": 5, "n_estimators": 2, "min_samples_leaf": 10_000})
    assert all(t.numNodes == 1 for t in lone.regressor.trees)


def test_cells_of_distinct_distances_are_bounded(spark):
    """As many distances as trips: cells are bins times pairs, and a forest loses less than five per cent."""
    n, bins = 6000, 128
    rows = spark.range(n).select(
        (F.col("id") % 3).alias("PULocationID"), (F.col("id") % 2).alias("DOLocationID"), F.pmod(F.xxhash64("id") / 1e12, F.lit(9.0)).alias("trip_distance"),
        F.when(F.col("id") % 4 == 0, "val").otherwise("train").alias("split"),
    )
    rows = rows.withColumn("duration", 5 + 4 * F.col("trip_distance") + F.col("PULocationID") + F.pmod(F.xxhash64("trip_distance"), F.lit(100)) / 50)
    exact, binned = (collapse(rows, ZONES_DISTANCE, binned=b).cache() for b in (None, edges(rows, ZONES_DISTANCE, bins)))
    assert exact.count() == n and binned.count() <= bins * 6 * 2
    assert binned.agg(F.sum(WEIGHT)).first()[0] == n
    params = {"n_estimators": 5, "max_depth": 6}
    fitted = [models.fit(c.filter("split = 'train'"), ZONES_DISTANCE, "RF", params) for c in (exact, binned)]
    val = rows.filter("split = 'val'")
    a, b = (models.row_rmse(models.predict(m, val)).first().rmse for m in fitted)
    assert b < 1.05 * a, (a, b)
    few = rows.withColumn("trip_distance", F.round("trip_distance"))
    kept = collapse(few, ZONES_DISTANCE, binned=edges(few, ZONES_DISTANCE, bins))
    assert sorted(kept.collect()) == sorted(collapse(few, ZONES_DISTANCE).select(*kept.columns).collect())
