"""Named queries over the test tables, one or more per operator.

Each takes `(spark, sf_dir)`, reads whole tables and returns a DataFrame. Doubles are rounded only
where the order of a sum may change the last digits.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions import codec
from kerbside.functions.columns import next_month, pair_key, zone_code, zone_text
from kerbside.operators import encode, linear, prepare, profile, registry, score, search
from kerbside.operators import train as models
from kerbside.operators.cells import LABEL, WEIGHT, collapse, rmse, uncollapsed
from kerbside.operators.encode import PAIR_DISTANCE, ZONES, ZONES_DISTANCE, FeatureSpec
from kerbside.operators.numbering import dense_ride_ids, source_ride_ids
from kerbside.plans.batch import load_by_alias, score_months
from kerbside.plans.training import feature_cells, load_features, prepare_features, search_and_register, train_and_log, train_month, training_rows
from kerbside.session import new_folder
from kerbside.sources.tables import event_trips, lineitem_trips, raw_lineitem
from kerbside.sources.trips import TIME_COLUMNS, canonical, month_path, read_canonical, write_canonical
from kerbside.streaming import records, service, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PICKUP = FeatureSpec(("PULocationID",))
# The feature sets compared on the leaderboard; each gives one mean-per-category model.
FEATURE_SETS = {
    "PULocationID": ("pu",),
    "DOLocationID": ("dz",),
    "PU_DO": ("pu", "dz"),
    "trip_distance": ("trip_distance",),
    "color": ("color",),
}
# Durations have two decimals, so their means are often exactly half way between two numbers of few
# digits, where engines may round either way. Seven digits keep clear of that.
MEAN_DIGITS = 7
GREEN_MONTHS = [(1996, 12), (1997, 1), (1997, 2)]
SMALL_FOREST = {"n_estimators": 10, "max_depth": 6, "random_state": 42}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def kept(spark: SparkSession, sf_dir: str, positions: bool = False) -> DataFrame:
    return prepare.drop_outliers(event_trips(spark, sf_dir, positions))


def _text(ts: str):
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


# ---- sources, projections -------------------------------------------------------------------


@query
def canonical_trips(spark, sf_dir):
    """Both raw layouts projected to one table."""
    green, yellow = (canonical(raw_lineitem(spark, sf_dir, c), c) for c in TIME_COLUMNS)
    trips = green.unionByName(yellow)
    return trips.select(
        _text("pickup_datetime").alias("pickup"),
        _text("dropoff_datetime").alias("dropoff"),
        "PULocationID",
        "DOLocationID",
        "trip_distance",
        "color",
        "year",
        "month",
    )


@query
def stored_months(spark, sf_dir):
    """Trips written by colour, year and month, read back with one month pruned to."""
    path = new_folder(spark, "canonical")
    write_canonical(lineitem_trips(spark, sf_dir), path, by_month=False)
    one_year = read_canonical(spark, path).filter((F.col("color") == "green") & (F.col("year") == 1996))
    return one_year.groupBy("color", "year", "month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("PULocationID").alias("zone_sum"), F.sum("trip_distance").alias("distance")
    )


@query
def trip_duration(spark, sf_dir):
    trips = prepare.with_interval(event_trips(spark, sf_dir))
    seconds = F.round(F.extract(F.lit("SECOND"), "duration_td").cast("double"), 6)
    return trips.select("event_id", "duration", seconds.alias("interval_second_part"))


@query
def zone_strings(spark, sf_dir):
    return event_trips(spark, sf_dir).select(
        "event_id",
        zone_text("PULocationID").alias("pu_text"),
        zone_code("PULocationID").alias("pu_code"),
        zone_code("DOLocationID").alias("do_code"),
    )


@query
def pair_feature(spark, sf_dir):
    return event_trips(spark, sf_dir).select("event_id", pair_key("PULocationID", "DOLocationID").alias("pu_do"))


@query
def feature_rows(spark, sf_dir):
    trips = encode.with_keys(kept(spark, sf_dir), PAIR_DISTANCE)
    return prepare.features_and_label(trips, ["event_id", "PU_DO_key", "trip_distance"])


@query
def ride_id_source(spark, sf_dir):
    return source_ride_ids(kept(spark, sf_dir, positions=True)).select("event_id", "ride_id")


@query
def ride_id_source_files(spark, sf_dir):
    """The form for months of several files: positions continue from file to file."""
    trips = event_trips(spark, sf_dir, positions=True)
    return source_ride_ids(prepare.drop_outliers(trips), trips).select("event_id", "ride_id")


@query
def ride_id_dense(spark, sf_dir):
    return dense_ride_ids(kept(spark, sf_dir, positions=True)).select("event_id", "ride_id")


# ---- filters and checks ---------------------------------------------------------------------


@query
def trips_kept(spark, sf_dir):
    return kept(spark, sf_dir).select("event_id", "duration")


@query
def retention_pct(spark, sf_dir):
    r = profile.retention(event_trips(spark, sf_dir))
    return r.withColumn("retention_pct", F.round("retention_pct", 6))


@query
def monthly_retention(spark, sf_dir):
    r = profile.retention(lineitem_trips(spark, sf_dir), by=("color", "year", "month"))
    return r.withColumn("retention_pct", F.round("retention_pct", 6))


@query
def null_check(spark, sf_dir):
    return profile.missing_check(event_trips(spark, sf_dir), ["duration", "PULocationID", "DOLocationID"])


@query
def table_shape(spark, sf_dir):
    return profile.shape(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


# ---- aggregates -----------------------------------------------------------------------------


def _rounded(stats: DataFrame) -> DataFrame:
    return stats.withColumns({c: F.round(c, 6) for c in ("mean", "std_sample", "std_population", "total", "low", "high")})


@query
def duration_stats(spark, sf_dir):
    return _rounded(profile.distribution(kept(spark, sf_dir), "duration"))


@query
def duration_stats_unfiltered(spark, sf_dir):
    return _rounded(profile.distribution(event_trips(spark, sf_dir), "duration"))


@query
def monthly_duration_stats(spark, sf_dir):
    trips = prepare.drop_outliers(lineitem_trips(spark, sf_dir))
    return _rounded(profile.distribution(trips, "duration", by=("color", "year", "month")))


@query
def feature_count(spark, sf_dir):
    trips = kept(spark, sf_dir).withColumns({z: zone_code(z) for z in prepare.ZONE_COLUMNS})
    return profile.feature_count(trips, prepare.ZONE_COLUMNS, ("trip_distance",))


@query
def duration_histogram(spark, sf_dir):
    return profile.histogram(event_trips(spark, sf_dir), ["duration"], 0.0, 60.0, 30)


@query
def file_inventory(spark, sf_dir):
    files = profile.file_inventory(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "n_bytes", "n_rows")


@query
def preview_first(spark, sf_dir):
    trips = profile.preview(event_trips(spark, sf_dir), ["event_id"], 5)
    return trips.select("event_id", "duration", "PULocationID", "DOLocationID")


# ---- splits ---------------------------------------------------------------------------------


@query
def split_counts(spark, sf_dir):
    return kept(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("duration"), 6).alias("mean"))


@query
def month_split(spark, sf_dir):
    trips = prepare.drop_outliers(lineitem_trips(spark, sf_dir))
    marked = prepare.with_month_split(trips, (1996, 12), (1997, 1), (1997, 2))
    return marked.groupBy("color", "split").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("duration"), 6).alias("mean"))


def _month_cells(spark, sf_dir, *keys: str) -> DataFrame:
    trips = prepare.drop_outliers(lineitem_trips(spark, sf_dir))
    return trips.groupBy("color", "year", "month", *keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("duration").alias("mean"),
        (F.var_pop("duration") * F.count(F.lit(1))).alias("spread"),
    )


@query
def next_month_roll(spark, sf_dir):
    """Train and validation rows of every month with its following month."""
    months = _month_cells(spark, sf_dir)
    train = months.select("color", "year", "month", F.col("n").alias("n_train"), next_month("year", "month").alias("next"))
    val = months.select("color", F.make_date("year", "month", F.lit(1)).alias("next"), F.col("n").alias("n_val"))
    pairs = train.join(val, ["color", "next"])
    return pairs.select(
        "color", "year", "month", F.year("next").alias("val_year"), F.month("next").alias("val_month"), "n_train", "n_val"
    )


@query
def next_month_rmse(spark, sf_dir):
    """For every month: a mean-per-pickup-zone model, validated on the following month.

    Both sides of the join are cells (one row per month and zone), never trips.
    """
    # Used three times; one row per month and zone, so kept instead of scanning the trips again.
    cells = _month_cells(spark, sf_dir, "PULocationID").persist(StorageLevel.MEMORY_AND_DISK)
    model = cells.select("color", next_month("year", "month").alias("period"), "PULocationID", F.col("mean").alias("effect"))
    fallback = model.groupBy("color", "period").agg(F.avg("effect").alias("unseen"))
    val = cells.withColumn("period", F.make_date("year", "month", F.lit(1)))
    scored = val.join(fallback, ["color", "period"]).join(model, ["color", "period", "PULocationID"], "left")
    error = F.col("n") * F.pow(F.col("mean") - F.coalesce("effect", "unseen"), 2) + F.col("spread")
    result = scored.groupBy("color", "year", "month").agg(
        F.sum("n").alias("n"), F.round(F.sqrt(F.sum(error) / F.sum("n")), 6).alias("rmse")
    )
    return result


# ---- encoding -------------------------------------------------------------------------------


def _train_cells(spark, sf_dir, spec: FeatureSpec) -> DataFrame:
    return feature_cells(event_trips(spark, sf_dir).filter("split = 'train'"), spec)


@query
def vocabulary(spark, sf_dir):
    return encode.vocabulary(kept(spark, sf_dir).filter("split = 'train'"), PAIR_DISTANCE)


@query
def one_hot_long(spark, sf_dir):
    """Feature vectors of all trips under the train vocabulary, encoded by joins; unseen pairs have no entry."""
    trips = kept(spark, sf_dir)
    names = encode.vocabulary(trips.filter("split = 'train'"), PAIR_DISTANCE)
    return encode.joined_entries(encode.joined(trips, names, PAIR_DISTANCE), ["event_id"])


@query
def one_hot_stages(spark, sf_dir):
    """The same vectors of the test trips from the fitted pipeline that models are saved with."""
    pairs = FeatureSpec(("PU_DO",))  # the vocabulary needs no distances
    cells = _train_cells(spark, sf_dir, pairs)
    fitted = encode.fit_encoder(cells, PAIR_DISTANCE)
    cells.unpersist()
    test = kept(spark, sf_dir).filter("split = 'test'")
    return encode.vector_entries(fitted.transform(test), ["event_id"])


@query
def feature_sets(spark, sf_dir):
    """The train, val and test sets behind every fit: cells, trips and label sums."""
    cells = collapse(kept(spark, sf_dir), ZONES_DISTANCE)
    return cells.groupBy("split").agg(
        F.count(F.lit(1)).alias("cells"),
        F.sum(WEIGHT).cast("bigint").alias("trips"),
        F.round(F.sum(F.col(WEIGHT) * F.col(LABEL)), 6).alias("label_sum"),
    )


# ---- training and evaluation ----------------------------------------------------------------


def _fit(spark, sf_dir, spec: FeatureSpec, model_type: str = "LR", params: dict | None = None):
    cells = training_rows(event_trips(spark, sf_dir), spec, model_type)
    train, val = (cells.filter(F.col("split") == s) for s in ("train", "val"))
    return models.fit(train, spec, model_type, params, val if model_type == "XGB" else None), cells


def _model(spark, sf_dir, spec: FeatureSpec) -> models.Trained:
    """A fitted model whose cells are no longer needed."""
    model, cells = _fit(spark, sf_dir, spec)
    cells.unpersist()
    return model


@query
def ols_group_mean(spark, sf_dir):
    """Least squares on one categorical is the mean per category."""
    model, cells = _fit(spark, sf_dir, PICKUP)
    scored = models.predict(model, cells.select("PULocationID").distinct())
    found = scored.select(F.col("PULocationID").cast("string").alias("PULocationID"), F.round("prediction", MEAN_DIGITS).alias("prediction"))
    return _released(found, cells)


@query
def ols_numeric(spark, sf_dir):
    model, cells = _fit(spark, sf_dir, FeatureSpec((), ("trip_distance",)))
    slope = model.pipeline.numbers["trip_distance"]
    n = cells.filter("split = 'train'").agg(F.sum(WEIGHT).cast("bigint").alias("n"))
    return n.select(
        "n", F.round(F.lit(slope), 6).alias("slope"), F.round(F.lit(model.intercept), 6).alias("intercept")
    )


@query
def ols_orthogonality(spark, sf_dir):
    """What defines least squares on both zones: residuals sum to zero in every category. The sums of the answers
    of the trips in each are those of their durations."""
    model, cells = _fit(spark, sf_dir, ZONES)
    scored = models.predict(model, cells.filter("split = 'train'"))
    entry = F.explode(F.array(*[F.concat(F.lit(f"{z}="), F.col(z).cast("string")) for z in ZONES.categorical])).alias("feature")
    total = F.round(F.sum(F.col(WEIGHT) * F.col("prediction")), 3).alias("total")
    sums = scored.select(entry, WEIGHT, "prediction").groupBy("feature").agg(F.sum(WEIGHT).cast("bigint").alias("n"), total)
    return _released(sums, cells)


def _folded(spark, sf_dir) -> DataFrame:
    """Trips between few zones, with a duration that is a sum of two zone effects."""
    trips = event_trips(spark, sf_dir).filter("PULocationID IS NOT NULL")
    pu, do = F.pmod(F.col("PULocationID").cast("bigint"), F.lit(12)), F.pmod("DOLocationID", F.lit(10))
    trips = trips.select("event_id", "split", pu.alias("PULocationID"), do.alias("DOLocationID"))
    return trips.withColumn(LABEL, F.col("PULocationID") * 1.5 + F.col("DOLocationID") * F.col("DOLocationID") * 0.25)


@query
def zones_exact(spark, sf_dir):
    """Least squares on both zones finds effects that add up: the answer is the label."""
    trips = _folded(spark, sf_dir)
    model = models.fit(collapse(trips.filter("split = 'train'"), ZONES, LABEL), ZONES)
    scored = models.predict(model, trips.filter("split = 'test'"))
    return scored.select("event_id", F.round("prediction", 6).alias("prediction"))


@query
def zone_islands(spark, sf_dir):
    """Trained on trips inside two sets of zones without a trip between them, asked about all pairs."""
    trips = _folded(spark, sf_dir)
    inside = trips.filter("PULocationID % 2 = DOLocationID % 2 AND split = 'train'")
    model = models.fit(collapse(inside, ZONES, LABEL), ZONES)
    scored = models.predict(model, trips.select("PULocationID", "DOLocationID").distinct())
    return scored.select("PULocationID", "DOLocationID", F.round("prediction", 6).alias("prediction"))


@query
def ols_zones_distance(spark, sf_dir):
    """Both zones and a distance, on trips: residuals vanish in every zone and against the distance."""
    trips = event_trips(spark, sf_dir)
    rows = trips.select("split", "DOLocationID", "trip_distance", F.pmod(F.col("PULocationID").cast("bigint"), F.lit(12)).alias("PULocationID"))
    rows = rows.filter("PULocationID IS NOT NULL AND split = 'train'").withColumn("DOLocationID", F.pmod("DOLocationID", F.lit(10)))
    rows = rows.withColumn(LABEL, F.col("PULocationID") * 2.0 - F.col("DOLocationID") + 1.75 * F.col("trip_distance"))
    model = models.fit(uncollapsed(rows, ZONES_DISTANCE, LABEL), ZONES_DISTANCE)
    scored = models.predict(model, rows)
    return scored.groupBy("PULocationID", "DOLocationID").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("prediction"), MEAN_DIGITS).alias("prediction"))


@query
def ols_pair_distance(spark, sf_dir):
    """Exact least squares on pair and distance, for any number of pairs."""
    rows = uncollapsed(kept(spark, sf_dir), PAIR_DISTANCE, by=("event_id", "split"))
    model = models.fit(rows.filter("split = 'train'"), PAIR_DISTANCE)
    scored = models.predict(model, rows)
    return scored.select("event_id", F.round("prediction", 6).alias("prediction"))


@query
def rmse_by_split(spark, sf_dir):
    model, cells = _fit(spark, sf_dir, PICKUP)
    return _released(models.evaluate(model, cells).select("split", "n", F.round("rmse", 3).alias("rmse")), cells)


@query
def pair_rmse_by_split(spark, sf_dir):
    rows = uncollapsed(kept(spark, sf_dir), PAIR_DISTANCE)
    model = models.fit(rows.filter("split = 'train'"), PAIR_DISTANCE)
    scored = models.predict(model, rows)
    return scored.groupBy("split").agg(F.sum(WEIGHT).cast("bigint").alias("n"), F.round(rmse(), 6).alias("rmse"))


@query
def prediction_histogram(spark, sf_dir):
    """Predicted and actual durations of the test trips, bucket by bucket."""
    model = _model(spark, sf_dir, PICKUP)
    scored = models.predict(model, kept(spark, sf_dir).filter("split = 'test'"))
    return profile.histogram(
        scored.select("duration", F.round("prediction", MEAN_DIGITS).alias("prediction")), ["prediction", "duration"], 0.0, 60.0, 20
    )


def _tree_report(spark, sf_dir, model_type: str, params: dict) -> DataFrame:
    model, cells = _fit(spark, sf_dir, ZONES_DISTANCE, model_type, params)
    return _released(models.evaluate(model, cells), cells)


def _released(result: DataFrame, cells: DataFrame) -> DataFrame:
    """A report of a few rows, computed while its cells are held, which are given free."""
    table = result.toArrow()
    cells.unpersist()
    return result.sparkSession.createDataFrame(table, result.schema)


@query
def zones_exact_tables(spark, sf_dir):
    """`zones_exact` by conjugate gradients over effect tables, as if there were too many zones for columns."""
    trips = _folded(spark, sf_dir)
    found = linear.fit(collapse(trips.filter("split = 'train'"), ZONES, LABEL), ZONES, columns=0)
    return found.predict(trips.filter("split = 'test'")).select("event_id", F.round("prediction", 6).alias("prediction"))


@query
def zone_islands_tables(spark, sf_dir):
    """`zone_islands` by effect tables: least norm on each island."""
    trips = _folded(spark, sf_dir)
    inside = trips.filter("PULocationID % 2 = DOLocationID % 2 AND split = 'train'")
    found = linear.fit(collapse(inside, ZONES, LABEL), ZONES, columns=0)
    scored = found.predict(trips.select("PULocationID", "DOLocationID").distinct())
    return scored.select("PULocationID", "DOLocationID", F.round("prediction", 6).alias("prediction"))


def _tree_answers(spark, sf_dir, model_type: str, params: dict) -> DataFrame:
    """The answer of a model on both zones for every kept trip."""
    model, cells = _fit(spark, sf_dir, ZONES, model_type, params)
    cells.unpersist()
    return models.predict(model, kept(spark, sf_dir)).select("event_id", F.round("prediction", 6).alias("prediction"))


ONE_TREE = {"n_estimators": 1, "bootstrap": False}
STUMPS = {"max_depth": 1, "min_child_weight": 1}


@query
def tree_exact(spark, sf_dir):
    """One tree with one split: the best cut of the zones in the order of their means."""
    return _tree_answers(spark, sf_dir, "RF", {**ONE_TREE, "max_depth": 1})


@query
def tree_split_limit(spark, sf_dir):
    """A tree of depth 2 whose nodes are split only if they hold half of the trips, next to one without the limit."""
    half = kept(spark, sf_dir).filter("split = 'train'").count() // 2
    free, limited = (_tree_answers(spark, sf_dir, "RF", {**ONE_TREE, "max_depth": 2, "min_samples_split": n}) for n in (2, half))
    return free.join(limited.withColumnRenamed("prediction", "limited"), "event_id")


@query
def boost_exact(spark, sf_dir):
    """One and two rounds of boosted stumps."""
    one, two = (_tree_answers(spark, sf_dir, "XGB", {**STUMPS, "num_boost_round": n}) for n in (1, 2))
    return one.withColumnRenamed("prediction", "one").join(two.withColumnRenamed("prediction", "two"), "event_id")


@query
def forest_score(spark, sf_dir):
    return _tree_report(spark, sf_dir, "RF", SMALL_FOREST)


@query
def gbt_score(spark, sf_dir):
    return _tree_report(spark, sf_dir, "XGB", {"num_boost_round": 10, "max_depth": 4})


@query
def forest_full(spark, sf_dir):
    """The forest at its default size: 100 trees of depth 10."""
    return _tree_report(spark, sf_dir, "RF", {})


@query
def gbt_rounds(spark, sf_dir):
    """All 30 rounds of boosting, as the patience is longer than that; trees of depth 6."""
    return _tree_report(spark, sf_dir, "XGB", {"max_depth": 6})


@query
def forest_predictions(spark, sf_dir):
    """A forest's answer for every trip, computed once per combination of inputs."""
    model, cells = _fit(spark, sf_dir, ZONES, "RF", SMALL_FOREST)
    cells.unpersist()
    scored = models.predict_combinations(model, kept(spark, sf_dir), ZONES)
    return scored.select("event_id", "prediction")


@query
def search_trials(spark, sf_dir):
    """A seeded search: every trial is fitted on train and validated on the days that follow."""
    cells = feature_cells(event_trips(spark, sf_dir), ZONES_DISTANCE)
    space = {**search.FOREST_SPACE, "max_depth": (2, 6, 1), "n_estimators": (4, 10, 1)}
    found = search.search(search.forest_objective(cells, ZONES_DISTANCE), search.trials(spark, space, 4), parallel=4)
    cells.unpersist()
    rows = [(p["trial"], p["max_depth"], p["n_estimators"], p["min_samples_leaf"], loss) for p, loss in found]
    return spark.createDataFrame(rows, "trial INT, max_depth INT, n_estimators INT, min_samples_leaf INT, rmse DOUBLE")


@query
def retrain_top(spark, sf_dir):
    """The two best recorded parameter sets, read from the runs table and fitted again."""
    cells = feature_cells(event_trips(spark, sf_dir), ZONES_DISTANCE)
    path = new_folder(spark, "runs")
    space = {**search.FOREST_SPACE, "max_depth": (2, 5, 1), "n_estimators": (3, 6, 1)}
    objective = search.forest_objective(cells, ZONES_DISTANCE)
    for params, loss in search.search(objective, search.trials(spark, space, 3), parallel=3):
        registry.log_run(spark, path, "search", "RF", params, {"rmse": loss}, run_id=f"trial-{params['trial']}")
    best = registry.top_runs(registry.read_runs(spark, path), "search", 2).collect()
    results = search.retrain(cells, ZONES_DISTANCE, [r["params"] for r in best])
    cells.unpersist()
    rows = [(run["run_id"], m["val_rmse"], m["test_rmse"]) for run, (_, m) in zip(best, results)]
    return spark.createDataFrame(rows, "run_id STRING, val_rmse DOUBLE, test_rmse DOUBLE")


@query
def gbt_full(spark, sf_dir):
    """Boosting at its default size: 30 rounds of depth 30."""
    return _tree_report(spark, sf_dir, "XGB", {})


@query
def forest_predictions_full(spark, sf_dir):
    """The answers of 100 trees of depth 10."""
    model, cells = _fit(spark, sf_dir, ZONES, "RF", {})
    cells.unpersist()
    scored = models.predict_combinations(model, kept(spark, sf_dir), ZONES)
    return scored.select("event_id", "prediction")


@query
def search_full(spark, sf_dir):
    """All 15 trials over the full space, the best five trained again on record, champion and challenger named."""
    cells = feature_cells(event_trips(spark, sf_dir), ZONES_DISTANCE)
    root = new_folder(spark, "search")
    found = search_and_register(spark, cells, root)
    runs = registry.read_runs(spark, f"{root}/runs")
    named = runs.join(found.select("run_id", "alias"), "run_id", "left")
    metrics = [F.col("metrics")[m].alias(m) for m in ("rmse", "test_rmse")]
    params = [F.col("params")[p].try_cast("double").cast("int").alias(p) for p in sorted(search.FOREST_SPACE)]
    return _released(named.select("experiment", "run_id", *params, *metrics, "alias"), cells)


def _green_months(spark, sf_dir, root: str) -> None:
    """Three raw months of green trips, in one file each, where the plans look for them."""
    for year, month in GREEN_MONTHS:
        begin = F.col(TIME_COLUMNS["green"][0])
        rows = raw_lineitem(spark, sf_dir, "green").filter((F.year(begin) == year) & (F.month(begin) == month))
        rows.write.parquet(month_path("green", year, month, root))


@query
def train_month_run(spark, sf_dir):
    """A month's model by pickup zone, validated on the next month, as its run records it."""
    root = new_folder(spark, "train-month")
    _green_months(spark, sf_dir, f"{root}/in")
    train_month(spark, f"{root}/in", f"{root}/out", "green", *GREEN_MONTHS[0], spec=PICKUP)
    runs = registry.read_runs(spark, f"{root}/out/runs")
    return runs.select("experiment", "model_type", F.round(F.col("metrics")["val_rmse"], 6).alias("val_rmse"))


@query
def prepared_features(spark, sf_dir):
    """The feature sets of three months, written by the plan and loaded again."""
    root = new_folder(spark, "features")
    _green_months(spark, sf_dir, f"{root}/in")
    prepare_features(spark, f"{root}/in", f"{root}/out", "green", GREEN_MONTHS, PICKUP)
    sets = load_features(spark, f"{root}/out")
    return sets.groupBy("split").agg(F.sum(WEIGHT).cast("long").alias("n"), F.round(F.sum(F.col(WEIGHT) * F.col(LABEL)), 6).alias("total"))


@query
def score_months_summary(spark, sf_dir):
    """Two months scored by the model of the month before them, found by its path."""
    root = new_folder(spark, "score-months")
    _green_months(spark, sf_dir, f"{root}/in")
    run_id = train_month(spark, f"{root}/in", f"{root}/out", "green", *GREEN_MONTHS[0], spec=PICKUP)
    path = models.model_location(run_id, f"{root}/out", experiment="trip-duration")
    s = score_months(spark, f"{root}/in", [("green", *m) for m in GREEN_MONTHS[1:]], path, f"{root}/scored")
    return s.select("n", *[F.round(c, 3).alias(c) for c in ("total", "mean", "std_population")])


@query
def score_months_places(spark, sf_dir):
    """The same months, each written to a place that the caller names."""
    root = new_folder(spark, "score-months")
    _green_months(spark, sf_dir, f"{root}/in")
    run_id = train_month(spark, f"{root}/in", f"{root}/out", "green", *GREEN_MONTHS[0], spec=PICKUP)
    path = models.model_location(run_id, f"{root}/out", experiment="trip-duration")
    months = [("green", *m) for m in GREEN_MONTHS[1:]]
    score_months(spark, f"{root}/in", months, path, f"{root}/scored", output="predictions-{color}-{year:04d}-{month:02d}")
    parts = []
    for color, year, month in months:
        part = spark.read.parquet(f"{root}/scored/predictions-{color}-{year:04d}-{month:02d}")
        parts.append(score.summary(part).select(F.lit(month).alias("month"), "n", *[F.round(c, 3).alias(c) for c in ("total", "mean")]))
    return parts[0].unionByName(parts[1])


# ---- runs and promotion ---------------------------------------------------------------------


def mean_model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per feature set: the mean per category on train, its RMSE on every split.

    One pass over the trips aggregates the two zones with the colour, and the distance by itself;
    both have few groups, so tasks send little. The sets are then put together from these groups.
    """
    trips = kept(spark, sf_dir).select(
        "split",
        "duration",
        F.coalesce(F.col("PULocationID").cast("int"), F.lit(-1)).alias("pu"),
        F.coalesce(F.col("DOLocationID").cast("int"), F.lit(-1)).alias("dz"),
        "color",
        "trip_distance",
    )
    groups = trips.groupingSets(
        [["split", "pu", "dz", "color"], ["split", "trip_distance"]], "split", "pu", "dz", "color", "trip_distance"
    ).agg(
        F.grouping("pu").alias("by_distance"),
        F.count(F.lit(1)).alias("n"),
        F.avg("duration").alias("mean"),
        (F.var_pop("duration") * F.count(F.lit(1))).alias("spread"),
    )
    members = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("set"), F.concat_ws("_", *used).alias("key"), F.lit(int(used == ("trip_distance",))).alias("by_distance"))
                for name, used in FEATURE_SETS.items()
            ]
        )
    )
    total = F.sum("n")
    mean = F.sum(F.col("n") * F.col("mean")) / total
    cells = (
        groups.select("*", members.alias("f"))
        .filter(F.col("f.by_distance") == F.col("by_distance"))
        .groupBy("split", F.col("f.set").alias("feature_set"), F.col("f.key").alias("key"))
        .agg(
            total.alias("n"),
            mean.alias("mean"),
            # Spread inside the groups plus the spread of their means.
            (F.sum("spread") + F.sum(F.col("n") * F.col("mean") * F.col("mean")) - total * mean * mean).alias("spread"),
        )
        .persist(StorageLevel.MEMORY_AND_DISK)  # used three times below; one row per category
    )
    train = cells.filter("split = 'train'").select("feature_set", "key", F.col("mean").alias("effect"))
    unseen = train.groupBy("feature_set").agg(F.avg("effect").alias("unseen"))
    scored = cells.join(train, ["feature_set", "key"], "left").join(unseen, "feature_set")
    error = F.col("n") * F.pow(F.col("mean") - F.coalesce("effect", "unseen"), 2) + F.col("spread")
    by_split = scored.groupBy("feature_set", "split").agg(F.sqrt(F.sum(error) / F.sum("n")).alias("rmse"))
    wide = by_split.groupBy("feature_set").pivot("split", ["train", "val", "test"]).agg(F.first("rmse"))
    # The colour model was withdrawn: its run stays in the table but is not active.
    return wide.select(
        F.concat(F.lit("mean-"), "feature_set").alias("run_id"),
        F.lit("mean-models").alias("experiment"),
        F.when(F.col("feature_set") == "color", "deleted").otherwise(registry.ACTIVE).alias("status"),
        F.lit("mean").alias("model_type"),
        F.create_map(F.lit("feature_set"), F.col("feature_set")).alias("params"),
        F.create_map(
            F.lit("rmse"), F.col("val"), F.lit("train_rmse"), F.col("train"), F.lit("val_rmse"), F.col("val"),
            F.lit("test_rmse"), F.col("test"),
        ).alias("metrics"),
        F.create_map(F.lit("source"), F.lit("events")).alias("tags"),
    )


def _logged_runs(spark, sf_dir) -> DataFrame:
    path = new_folder(spark, "runs")
    registry.append_runs(mean_model_runs(spark, sf_dir), path)
    return registry.read_runs(spark, path)


@query
def active_runs(spark, sf_dir):
    runs = registry.active_runs(_logged_runs(spark, sf_dir), "mean-models")
    return runs.select("run_id", F.round(F.col("metrics")["rmse"], 6).alias("rmse"))


@query
def leaderboard_topk(spark, sf_dir):
    return registry.leaderboard(_logged_runs(spark, sf_dir), "mean-models", 3)


@query
def run_report(spark, sf_dir):
    report = registry.run_report(_logged_runs(spark, sf_dir))
    number = F.round(F.col("value").try_cast("double"), 4)
    return report.select("run_id", "kind", "name", F.when(F.col("kind") == "params", F.col("value")).alias("text"), number.alias("number"))


@query
def champion_challenger(spark, sf_dir):
    found = registry.candidates(_logged_runs(spark, sf_dir))
    return found.select("experiment", "run_id", F.round("score", 6).alias("test_rmse"), "alias", "validation_status")


@query
def promotion(spark, sf_dir):
    """Candidates get aliases, the champion goes to staging and on to production."""
    path = new_folder(spark, "aliases")
    found = registry.candidates(_logged_runs(spark, sf_dir))
    named = found.select(
        F.lit("candidates").alias("model"), "alias", "run_id", "validation_status",
        F.lit(datetime(2024, 2, 1)).cast("timestamp_ntz").alias("ts"),
    )
    registry.set_aliases(named, path)
    steps = [("candidates", "champion", "staging", "staging_champion"), ("staging", "staging_champion", "production", "current")]
    for day, (source, source_alias, target, alias) in enumerate(steps, start=2):
        known = registry.read_aliases(spark, path)
        registry.set_aliases(registry.copy_alias(known, source, source_alias, target, alias, datetime(2024, 2, day)), path)
    return registry.current_aliases(registry.read_aliases(spark, path)).select("model", "alias", "run_id", "validation_status")


# ---- batch scoring --------------------------------------------------------------------------


def _written_predictions(spark, sf_dir, numbering: str = "source") -> DataFrame:
    model = _model(spark, sf_dir, PICKUP)
    path = new_folder(spark, "predictions")
    score.write_predictions(score.score_trips(model, event_trips(spark, sf_dir, positions=True), numbering), path)
    return score.read_predictions(spark, path)


@query
def batch_score(spark, sf_dir):
    """All trips scored, written by colour and month, and read back."""
    done = _written_predictions(spark, sf_dir)
    return done.withColumn("predicted_duration", F.round("predicted_duration", MEAN_DIGITS))


@query
def batch_score_dense(spark, sf_dir):
    done = _written_predictions(spark, sf_dir, "dense")
    return done.select("ride_id", F.round("predicted_duration", MEAN_DIGITS).alias("predicted_duration"))


@query
def batch_summary(spark, sf_dir):
    s = score.summary(_written_predictions(spark, sf_dir))
    return s.select("n", *[F.round(c, 3).alias(c) for c in ("total", "mean", "std_population")])


@query
def batch_score_zones(spark, sf_dir):
    """The flagship: least squares on both zones, fitted on train, scoring all trips."""
    model = _model(spark, sf_dir, ZONES)
    return score.score_trips(model, event_trips(spark, sf_dir, positions=True)).select("ride_id", "predicted_duration")


@query
def batch_score_zones_exact(spark, sf_dir):
    """The flagship on few zones, fitted on a label that is the sum of an effect of each: it answers the label."""
    pickup, dropoff = F.pmod(F.col("PULocationID").cast("bigint"), F.lit(12)), F.pmod("DOLocationID", F.lit(10))
    trips = event_trips(spark, sf_dir, positions=True).withColumns({"PULocationID": pickup, "DOLocationID": dropoff})
    label = F.coalesce(F.col("PULocationID") * 1.5, F.lit(5.0)) + F.col("DOLocationID") * F.col("DOLocationID") * 0.25
    model = models.fit(collapse(trips.filter("split = 'train'").withColumn(LABEL, label), ZONES, LABEL), ZONES)
    return score.score_trips(model, trips).select("ride_id", F.round("predicted_duration", 6).alias("predicted_duration"))


@query
def ride_id_many_files(spark, sf_dir):
    """A raw month of several files, scored by the batch plan: positions continue from file to file."""
    root = new_folder(spark, "months")
    trips = event_trips(spark, sf_dir)
    first = trips.agg(F.min("pickup_datetime")).first()[0]
    raw = trips.select(
        "event_id", F.col("pickup_datetime").alias("lpep_pickup_datetime"), F.col("dropoff_datetime").alias("lpep_dropoff_datetime"),
        "PULocationID", "DOLocationID", "trip_distance",
    )
    month = ("green", first.year, first.month)
    raw.repartitionByRange(5, "event_id").sortWithinPartitions("event_id").write.parquet(month_path(*month, f"{root}/in"))
    models.save(_model(spark, sf_dir, PICKUP), f"{root}/model")
    score_months(spark, f"{root}/in", [month], f"{root}/model", f"{root}/out")
    done = score.read_predictions(spark, f"{root}/out")
    return done.select("ride_id", F.round("predicted_duration", MEAN_DIGITS).alias("predicted_duration"))


@query
def alias_score(spark, sf_dir):
    """A model is trained, saved and named; another reader loads it by alias and scores."""
    root = new_folder(spark, "models")
    cells = feature_cells(event_trips(spark, sf_dir), PICKUP)
    run_id = train_and_log(spark, cells, PICKUP, root, "durations")
    registry.set_alias(spark, f"{root}/aliases", "durations", "champion", run_id, "approved")
    cells.unpersist()
    model = load_by_alias(spark, root, "durations", "durations", "champion")
    scored = models.predict(model, kept(spark, sf_dir))
    return scored.select("event_id", F.round("prediction", MEAN_DIGITS).alias("prediction"))


@query
def request_scores(spark, sf_dir):
    """Single rides as JSON lines, answered with duration and model version."""
    model = _model(spark, sf_dir, PICKUP)
    path = new_folder(spark, "requests")
    trips = event_trips(spark, sf_dir).withColumn("PULocationID", F.col("PULocationID").cast("bigint"))
    trips.select("PULocationID", "DOLocationID", "trip_distance").write.json(path)
    answers = score.score_requests(model, records.read_requests(spark, path), "run-1")
    return answers.groupBy("PULocationID", "model_version").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.max("duration"), MEAN_DIGITS).alias("duration")
    )


@query
def request_rejects(spark, sf_dir):
    """Requests as JSON lines, some cut off, some no JSON, some without the number: refused, not answered."""
    model = _model(spark, sf_dir, PAIR_DISTANCE)
    path = new_folder(spark, "requests")
    whole = F.to_json(F.struct("PULocationID", "DOLocationID", "trip_distance"))
    line = (
        F.when(F.col("event_id") % 10 == 1, F.substring(whole, 1, 12))
        .when(F.col("event_id") % 10 == 2, "not json")
        .when(F.col("event_id") % 10 == 3, F.to_json(F.struct("DOLocationID")))
        .otherwise(whole)
    )
    trips = event_trips(spark, sf_dir).withColumn("PULocationID", F.col("PULocationID").cast("bigint"))
    trips.select(line.alias("value")).write.text(path)
    requests = records.read_requests(spark, path)
    refused = score.request_rejects(model, requests).select("reason")
    answered = score.score_requests(model, requests, "run-1").select(F.lit("answered").alias("reason"))
    return refused.unionByName(answered).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# ---- streaming ------------------------------------------------------------------------------


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips as delivered records. Trips without a pickup zone are sent broken in four ways."""
    trips = event_trips(spark, sf_dir).select(
        "event_id",
        F.col("PULocationID").cast("bigint").alias("PULocationID"),
        "DOLocationID",
        "trip_distance",
        F.timestamp_diff("SECOND", F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz"), F.col("pickup_datetime"))
        .cast("double")
        .alias("arrival"),
    )
    return _break(records.pack(trips, "event_id", "arrival"))


def _break(packed: DataFrame) -> DataFrame:
    """Damage the payload of records whose ride has no pickup zone, in turn: no base64, no JSON, no ride, as it is (an unknown zone)."""
    def text(s: str):
        return F.base64(F.lit(s).cast("binary"))

    def damage(r):
        i = r["kinesis"]["partitionKey"].cast("bigint")
        data = r["kinesis"]["data"]
        no_zone = codec.payload_text(data).contains('"PULocationID":null')
        broken = (
            F.when(~no_zone | (i % 4 == 3), data)
            .when(i % 4 == 0, F.lit("!!bad"))
            .when(i % 4 == 1, text("no json"))
            .otherwise(text('{"ride_id": 1}'))
        )
        return r.withField("kinesis", r["kinesis"].withField("data", broken))

    return packed.select(F.transform("Records", damage).alias("Records"))


@query
def envelope_roundtrip(spark, sf_dir):
    """Encode every trip as a record, decode all records again."""
    decoded = records.decode(envelopes(spark, sf_dir))
    return records.rides(decoded, PICKUP.inputs).select("ride_id", "PULocationID", "DOLocationID", "trip_distance")


@query
def quarantine_split(spark, sf_dir):
    """Envelopes as JSON lines, each followed by itself cut in half: what cannot be scored, and why."""
    path = new_folder(spark, "envelopes")
    line = F.to_json(F.struct("Records"), {"ignoreNullFields": "false"})
    both = F.explode(F.array("line", F.substring("line", 1, F.floor(F.length("line") / 2).cast("int"))))
    envelopes(spark, sf_dir).select(line.alias("line")).select(both.alias("value")).write.text(path)
    decoded = records.decode(records.read_envelopes(spark, path, streaming=False))
    rejected = records.rejects(decoded, PICKUP.inputs)
    key = F.split("event_id", ":")[1].cast("bigint")
    return rejected.select(key.alias("ride_id"), "reason")


@query
def prediction_events(spark, sf_dir):
    """Event fields parsed back from the JSON messages."""
    model = _model(spark, sf_dir, PICKUP)
    events = service.prediction_events(model, envelopes(spark, sf_dir), "run-1")
    parsed = records.messages(events).select("key", F.from_json("value", codec.PREDICTION_EVENT).alias("e"))
    return parsed.select(
        "key", "e.model", "e.version", "e.prediction.ride_id", F.round("e.prediction.ride_duration", MEAN_DIGITS).alias("ride_duration")
    )


def run_stream(spark: SparkSession, sf_dir: str, model: models.Trained | PipelineModel) -> str:
    """Write all records as envelope files, stream them through the scorer, return the output folder."""
    root = new_folder(spark, "stream")
    envelopes(spark, sf_dir).write.json(f"{root}/in")
    stream = records.read_envelopes(spark, f"{root}/in", maxFilesPerTrigger="64")
    publish = [sinks.message_sink(f"{root}/messages"), sinks.parquet_sink(f"{root}/events")]
    running = service.start(
        model, stream, "run-1", publish, f"{root}/checkpoint", sinks.parquet_sink(f"{root}/rejects"), {"availableNow": True}
    )
    running.awaitTermination()
    return root


@query
def stream_score(spark, sf_dir):
    """The stream's events, as read from its Parquet sink."""
    model = _model(spark, sf_dir, PICKUP)
    root = run_stream(spark, sf_dir, model)
    events = sinks.read_events(spark, f"{root}/events")
    return events.select(
        "model", "version", "prediction.ride_id", F.round("prediction.ride_duration", MEAN_DIGITS).alias("ride_duration")
    )


DRAIN = {"availableNow": True}


@query
def stream_once(spark, sf_dir):
    """All records are delivered, then all again to the restarted stream, which knows them from its state."""
    model = _model(spark, sf_dir, PICKUP)
    root = new_folder(spark, "stream")
    for _ in range(2):
        envelopes(spark, sf_dir).write.mode("append").json(f"{root}/in")
        stream = records.read_envelopes(spark, f"{root}/in", maxFilesPerTrigger="64")
        publish, held = [sinks.parquet_sink(f"{root}/events")], sinks.parquet_sink(f"{root}/rejects")
        service.start(model, stream, "run-1", publish, f"{root}/checkpoint", held, DRAIN, repeats_within="60 days").awaitTermination()
    events = sinks.read_events(spark, f"{root}/events")
    return events.select("prediction.ride_id", F.round("prediction.ride_duration", MEAN_DIGITS).alias("ride_duration"))


@query
def stream_windows(spark, sf_dir):
    """Predictions of the stream averaged by day of arrival."""
    model = _model(spark, sf_dir, PICKUP)
    root = new_folder(spark, "stream")
    envelopes(spark, sf_dir).write.json(f"{root}/in")
    stream = records.read_envelopes(spark, f"{root}/in", maxFilesPerTrigger="64")
    service.start_windows(model, stream, f"{root}/windows", f"{root}/checkpoint", "1 day", "60 days", DRAIN).awaitTermination()
    days = service.read_windows(spark, f"{root}/windows")
    return days.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "n", F.round("mean", 6).alias("mean"))


@query
def stream_promotion(spark, sf_dir):
    """Half of the records, then a promotion, then the other half: the stream follows the alias, batch by batch."""
    root = new_folder(spark, "stream")
    versions = {"run-1": _model(spark, sf_dir, PICKUP), "run-2": _model(spark, sf_dir, FeatureSpec(("DOLocationID",)))}
    sent = envelopes(spark, sf_dir)
    first = F.element_at("Records", 1)["kinesis"]["partitionKey"].cast("bigint")
    for turn, (run_id, model) in enumerate(versions.items()):
        models.save(model, models.model_location(run_id, root, experiment="durations"))
        registry.set_alias(spark, f"{root}/aliases", "durations", "production", run_id, "approved")
        sent.filter(F.floor(first / 100) % 2 == turn).write.mode("append").json(f"{root}/in")
        stream = records.read_envelopes(spark, f"{root}/in", maxFilesPerTrigger="64")
        scorers = service.by_alias(spark, root, "durations", "durations", "production")
        service.start(scorers, stream, None, [sinks.parquet_sink(f"{root}/events")], f"{root}/checkpoint", None, DRAIN).awaitTermination()
    events = sinks.read_events(spark, f"{root}/events")
    return events.select("version", "prediction.ride_id", F.round("prediction.ride_duration", MEAN_DIGITS).alias("ride_duration"))


@query
def stream_messages(spark, sf_dir):
    """The stream's keyed messages and its rejects, counted per sink."""
    model = _model(spark, sf_dir, PICKUP)
    root = run_stream(spark, sf_dir, model)
    sent = sinks.read_messages(spark, f"{root}/messages").select(F.lit("sent").alias("sink"), F.col("key").cast("bigint").alias("id"))
    held = spark.read.parquet(f"{root}/rejects").select(
        F.lit("held").alias("sink"), F.split("event_id", ":")[1].cast("bigint").alias("id")
    )
    return sent.unionByName(held).groupBy("sink").agg(F.count("id").alias("n"), F.sum("id").alias("id_sum"))


@query
def first_record(spark, sf_dir):
    """The earliest record of the stream."""
    decoded = records.decode(envelopes(spark, sf_dir))
    first = decoded.orderBy("arrival", F.col("partition_key").cast("bigint")).limit(1)
    return first.select(F.col("partition_key").alias("key"), F.col("arrival").cast("bigint").alias("arrival"))
