"""The same questions as SQL over the raw tables, for an independent engine."""

from __future__ import annotations

_ZONE = "CAST(CAST(coalesce({c}, -1) AS BIGINT) AS VARCHAR)"

TRIPS = f"""
WITH raw AS (
  SELECT event_id, ts AS pickup, event_type,
         ts + to_microseconds(CAST(round(value * 60e6) AS BIGINT)) AS dropoff,
         CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id % 265 + 1 AS DOUBLE) END AS pu,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS dz,
         CAST(event_id % 100 AS DOUBLE) / CAST(10 AS DOUBLE) AS trip_distance,
         CASE WHEN event_type IN ('view', 'click') THEN 'green' ELSE 'yellow' END AS color
  FROM events
), trips AS (
  SELECT *, CAST(date_diff('microsecond', pickup, dropoff) AS DOUBLE) / CAST(1e6 AS DOUBLE) / CAST(60 AS DOUBLE) AS duration,
         CASE WHEN day(pickup) <= 10 THEN 'train' WHEN day(pickup) <= 20 THEN 'val' ELSE 'test' END AS split,
         {_ZONE.format(c="pu")} AS pu_code, {_ZONE.format(c="dz")} AS do_code
  FROM raw
), paired AS (
  SELECT *, pu_code || '_' || do_code AS pu_do FROM trips
), kept AS (
  SELECT * FROM paired WHERE duration BETWEEN 1 AND 60
)
"""

LINEITEM = """
WITH raw AS (
  SELECT l_shipdate AS pickup, l_shipdate + to_microseconds(CAST(round(l_extendedprice / CAST(1000 AS DOUBLE) * 60e6) AS BIGINT)) AS dropoff,
         l_suppkey % 265 + 1 AS pu, l_partkey % 265 + 1 AS dz, l_quantity / CAST(2 AS DOUBLE) AS trip_distance,
         CASE WHEN l_linestatus = 'O' THEN 'green' ELSE 'yellow' END AS color
  FROM lineitem WHERE l_linestatus IN ('O', 'F')
), trips AS (
  SELECT *, CAST(date_diff('microsecond', pickup, dropoff) AS DOUBLE) / CAST(1e6 AS DOUBLE) / CAST(60 AS DOUBLE) AS duration,
         CAST(year(pickup) AS INTEGER) AS year, CAST(month(pickup) AS INTEGER) AS month,
         CAST(date_trunc('month', pickup) AS DATE) AS period
  FROM raw
), kept AS (
  SELECT * FROM trips WHERE duration BETWEEN 1 AND 60
)
"""



def _stumps(name: str, rows: str) -> str:
    """The best cut of the train rows of every node, and the answers for all rows: zones of a feature in the order
    of their means, cut where the squares of sums over counts are largest."""
    return f"""
, {name}_rows AS ({rows}
), {name}_zones AS (
  SELECT node, 'pu' AS f, pu_code AS k, count(*) AS n, sum(y) AS s, avg(y) AS m FROM {name}_rows WHERE split = 'train' GROUP BY node, pu_code
  UNION ALL
  SELECT node, 'do', do_code, count(*), sum(y), avg(y) FROM {name}_rows WHERE split = 'train' GROUP BY node, do_code
), {name}_sums AS (
  SELECT *, row_number() OVER w AS place, sum(n) OVER w AS ln, sum(s) OVER w AS ls,
         sum(n) OVER (PARTITION BY node, f) AS n_all, sum(s) OVER (PARTITION BY node, f) AS s_all
  FROM {name}_zones WINDOW w AS (PARTITION BY node, f ORDER BY m, k)
), {name}_cuts AS (
  SELECT node, f, place AS last, ls / ln AS left_mean, (s_all - ls) / (n_all - ln) AS right_mean
  FROM {name}_sums WHERE ln < n_all
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY ls * ls / ln + (s_all - ls) * (s_all - ls) / (n_all - ln) DESC) = 1
), {name}_answers AS (
  SELECT r.event_id, pu_code, do_code, split, y, CASE WHEN place <= last THEN 1 ELSE 2 END AS side,
         CASE WHEN place <= last THEN left_mean ELSE right_mean END AS p
  FROM {name}_rows r JOIN {name}_cuts c USING (node)
  LEFT JOIN {name}_sums z ON z.node = r.node AND z.f = c.f AND z.k = CASE c.f WHEN 'pu' THEN pu_code ELSE do_code END
)
"""


# The means of one month, asked about the two that follow.
FIRST_MONTH = LINEITEM + """
, model AS (
  SELECT pu, avg(duration) AS m FROM kept WHERE color = 'green' AND year = 1996 AND month = 12 GROUP BY pu
), unseen AS (SELECT avg(m) AS u FROM model
), scored AS (
  SELECT k.*, coalesce(m, u) AS p FROM kept k LEFT JOIN model USING (pu) CROSS JOIN unseen
  WHERE color = 'green' AND year = 1997 AND month IN (1, 2)
)
"""

# Least squares on one categorical: the mean per category; an unseen one gets the mean of the means.
MEANS = TRIPS + """
, model AS (
  SELECT pu_code, avg(duration) AS m FROM kept WHERE split = 'train' GROUP BY pu_code
), unseen AS (
  SELECT avg(m) AS u FROM model
), scored AS (
  SELECT k.*, coalesce(m, u) AS p FROM paired k LEFT JOIN model USING (pu_code) CROSS JOIN unseen
), kept_scored AS (
  SELECT * FROM scored WHERE duration BETWEEN 1 AND 60
)
"""

PAIR = TRIPS + """
, groups AS (
  SELECT pu_do, avg(trip_distance) AS mx, avg(duration) AS my FROM kept WHERE split = 'train' GROUP BY pu_do
), slope AS (
  SELECT sum((trip_distance - mx) * (duration - my)) / sum((trip_distance - mx) * (trip_distance - mx)) AS b
  FROM kept JOIN groups USING (pu_do) WHERE split = 'train'
), unseen AS (
  SELECT avg(my - b * mx) AS u FROM groups CROSS JOIN slope
), scored AS (
  SELECT k.*, coalesce(my - b * mx, u) + b * trip_distance AS p
  FROM kept k LEFT JOIN groups USING (pu_do) CROSS JOIN slope CROSS JOIN unseen
)
"""

RUNS = TRIPS + """
, long AS (
  SELECT split, duration, 'PULocationID' AS s, pu_code AS k FROM kept UNION ALL
  SELECT split, duration, 'DOLocationID', do_code FROM kept UNION ALL
  SELECT split, duration, 'PU_DO', pu_do FROM kept UNION ALL
  SELECT split, duration, 'trip_distance', CAST(trip_distance AS VARCHAR) FROM kept UNION ALL
  SELECT split, duration, 'color', color FROM kept
), model AS (
  SELECT s, k, avg(duration) AS m FROM long WHERE split = 'train' GROUP BY s, k
), unseen AS (
  SELECT s, avg(m) AS u FROM model GROUP BY s
), by_split AS (
  SELECT s, split, sqrt(avg((duration - coalesce(m, u)) * (duration - coalesce(m, u)))) AS r
  FROM long LEFT JOIN model USING (s, k) JOIN unseen USING (s) GROUP BY s, split
), runs AS (
  SELECT 'mean-' || s AS run_id, s, CASE WHEN s = 'color' THEN 'deleted' ELSE 'active' END AS status,
         max(CASE WHEN split = 'train' THEN r END) AS train_rmse,
         max(CASE WHEN split = 'val' THEN r END) AS val_rmse,
         max(CASE WHEN split = 'test' THEN r END) AS test_rmse
  FROM by_split GROUP BY s
), placed AS (
  SELECT *, row_number() OVER (ORDER BY test_rmse, run_id) AS place FROM runs WHERE status = 'active'
)
"""

_STATS = """
  count(duration) AS n, round(avg(duration), 6) AS mean, round(stddev_samp(duration), 6) AS std_sample,
  round(stddev_pop(duration), 6) AS std_population, round(sum(duration), 6) AS total,
  round(min(duration), 6) AS low, round(max(duration), 6) AS high
"""

_RETENTION = """
  count(*) AS n_rows, CAST(sum(CASE WHEN duration BETWEEN 1 AND 60 THEN 1 ELSE 0 END) AS BIGINT) AS n_kept,
  round(avg(CASE WHEN duration BETWEEN 1 AND 60 THEN 1.0::DOUBLE ELSE 0 END) * 100, 6) AS retention_pct
"""


def _histogram(source: str, low: float, high: float, bins: int) -> str:
    return f"""
SELECT kind, CAST(CASE WHEN v < {low} THEN -1 WHEN v = {high} THEN {bins - 1} WHEN v > {high} THEN {bins}
       ELSE floor((v - {low}) / CAST({(high - low) / bins!r} AS DOUBLE)) END AS INTEGER) AS bucket, count(*) AS n
FROM ({source}) WHERE v IS NOT NULL GROUP BY 1, 2
"""


_RIDE_ID = "strftime(pickup, '%Y/%m') || '_' || CAST({position} AS VARCHAR)"
_SOURCE_ID = _RIDE_ID.format(position="event_id")
_DENSE_ID = _RIDE_ID.format(position="(row_number() OVER (PARTITION BY color ORDER BY event_id) - 1)")

# Few zones, and a label that is the sum of an effect of each.
FOLDED = TRIPS + """
, folded AS (
  SELECT event_id, split, trip_distance, CAST(pu AS BIGINT) % 12 AS pu, dz % 10 AS dz,
         CAST(CAST(pu AS BIGINT) % 12 AS DOUBLE) * 1.5 AS a, CAST((dz % 10) * (dz % 10) AS DOUBLE) * 0.25 AS b
  FROM trips WHERE pu IS NOT NULL
)
"""

_ISLANDS = FOLDED + """
, inside AS (SELECT * FROM folded WHERE pu % 2 = dz % 2 AND split = 'train'
), x AS (SELECT pu % 2 AS k, count(*) AS n, avg(a) AS u FROM (SELECT DISTINCT pu, a FROM inside) GROUP BY 1
), y AS (SELECT dz % 2 AS k, count(*) AS m, avg(b) AS v FROM (SELECT DISTINCT dz, b FROM inside) GROUP BY 1
), island AS (SELECT *, CAST(n * m AS DOUBLE) / (n + m) AS pull FROM x JOIN y USING (k)
), moved AS (SELECT sum(pull * (u + v)) / sum(pull) AS s FROM island
)
SELECT DISTINCT pu AS "PULocationID", dz AS "DOLocationID",
       round(s + (a - i.u + (i.u + i.v - s) * i.m / (i.n + i.m)) + (b - j.v + (j.u + j.v - s) * j.n / (j.n + j.m)), 6) AS prediction
FROM folded JOIN island i ON i.k = pu % 2 JOIN island j ON j.k = dz % 2 CROSS JOIN moved
"""

SQL: dict[str, str] = {
    "canonical_trips": LINEITEM + """
SELECT strftime(pickup, '%Y-%m-%d %H:%M:%S.%f') AS pickup, strftime(dropoff, '%Y-%m-%d %H:%M:%S.%f') AS dropoff,
       pu AS "PULocationID", dz AS "DOLocationID", trip_distance, color, year, month FROM trips
""",
    "stored_months": LINEITEM + """
SELECT color, year, month, count(*) AS n, CAST(sum(pu) AS BIGINT) AS zone_sum, sum(trip_distance) AS distance
FROM trips WHERE color = 'green' AND year = 1996 GROUP BY ALL
""",
    "trip_duration": TRIPS + """
SELECT event_id, duration,
       round((date_diff('microsecond', pickup, dropoff) % 60000000) / CAST(1e6 AS DOUBLE), 6) AS interval_second_part
FROM trips
""",
    "zone_strings": TRIPS + """
SELECT event_id, coalesce(CAST(pu AS VARCHAR), 'nan') AS pu_text, pu_code, do_code FROM trips
""",
    "pair_feature": TRIPS + "SELECT event_id, pu_do FROM paired",
    "feature_rows": TRIPS + 'SELECT event_id, pu_do AS "PU_DO_key", trip_distance, duration AS label FROM kept',
    "ride_id_source": TRIPS + f"SELECT event_id, {_SOURCE_ID} AS ride_id FROM kept",
    "ride_id_source_files": TRIPS + f"SELECT event_id, {_SOURCE_ID} AS ride_id FROM kept",
    "ride_id_dense": TRIPS + f"SELECT event_id, {_DENSE_ID} AS ride_id FROM kept",
    "trips_kept": TRIPS + "SELECT event_id, duration FROM kept",
    "retention_pct": TRIPS + f"SELECT {_RETENTION} FROM trips",
    "monthly_retention": LINEITEM + f"SELECT color, year, month, {_RETENTION} FROM trips GROUP BY color, year, month",
    "null_check": TRIPS + """
SELECT coalesce(bool_or(duration IS NULL OR isnan(duration)), false) AS duration_missing,
       coalesce(bool_or(pu IS NULL OR isnan(pu)), false) AS "PULocationID_missing",
       coalesce(bool_or(dz IS NULL), false) AS "DOLocationID_missing" FROM trips
""",
    "table_shape": """
SELECT (SELECT count(*) FROM lineitem) AS n_rows,
       (SELECT CAST(count(*) AS INTEGER) FROM (DESCRIBE lineitem)) AS n_columns
""",
    "duration_stats": TRIPS + f"SELECT {_STATS} FROM kept",
    "duration_stats_unfiltered": TRIPS + f"SELECT {_STATS} FROM trips",
    "monthly_duration_stats": LINEITEM + f"SELECT color, year, month, {_STATS} FROM kept GROUP BY color, year, month",
    "feature_count": TRIPS + """
SELECT count(DISTINCT pu_code) + count(DISTINCT do_code) + 1 AS n_features FROM kept
""",
    "duration_histogram": TRIPS + _histogram("SELECT 'duration' AS kind, duration AS v FROM trips", 0.0, 60.0, 30),
    "preview_first": TRIPS + """
SELECT event_id, duration, pu AS "PULocationID", dz AS "DOLocationID" FROM trips ORDER BY event_id LIMIT 5
""",
    "split_counts": TRIPS + "SELECT split, count(*) AS n, round(avg(duration), 6) AS mean FROM kept GROUP BY split",
    "month_split": LINEITEM + """
SELECT color, CASE WHEN year = 1996 THEN 'train' WHEN month = 1 THEN 'val' ELSE 'test' END AS split,
       count(*) AS n, round(avg(duration), 6) AS mean
FROM kept WHERE (year = 1996 AND month = 12) OR (year = 1997 AND month IN (1, 2)) GROUP BY 1, 2
""",
    "next_month_roll": LINEITEM + """
, months AS (SELECT color, year, month, period, count(*) AS n FROM kept GROUP BY ALL)
SELECT t.color, t.year, t.month, v.year AS val_year, v.month AS val_month, t.n AS n_train, v.n AS n_val
FROM months t JOIN months v ON t.color = v.color AND v.period = CAST(t.period + INTERVAL 1 MONTH AS DATE)
""",
    "next_month_rmse": LINEITEM + """
, model AS (
  SELECT color, CAST(period + INTERVAL 1 MONTH AS DATE) AS period, pu, avg(duration) AS m FROM kept GROUP BY ALL
), unseen AS (SELECT color, period, avg(m) AS u FROM model GROUP BY ALL)
SELECT color, year, month, count(*) AS n, round(sqrt(avg(pow(duration - coalesce(m, u), 2))), 6) AS rmse
FROM kept JOIN unseen USING (color, period) LEFT JOIN model USING (color, period, pu) GROUP BY color, year, month
""",
    "train_month_run": FIRST_MONTH + """
SELECT 'trip-duration' AS experiment, 'LR' AS model_type, round(sqrt(avg(pow(duration - p, 2))), 6) AS val_rmse
FROM scored WHERE month = 1
""",
    "prepared_features": LINEITEM + """
SELECT CASE WHEN year = 1996 THEN 'train' WHEN month = 1 THEN 'val' ELSE 'test' END AS split,
       count(*) AS n, round(sum(duration), 6) AS total
FROM kept WHERE color = 'green' AND ((year = 1996 AND month = 12) OR (year = 1997 AND month IN (1, 2))) GROUP BY 1
""",
    "score_months_places": FIRST_MONTH + """
SELECT month, count(*) AS n, round(sum(p), 3) AS total, round(avg(p), 3) AS mean FROM scored GROUP BY month
""",
    "score_months_summary": FIRST_MONTH + """
SELECT count(*) AS n, round(sum(p), 3) AS total, round(avg(p), 3) AS mean, round(stddev_pop(p), 3) AS std_population FROM scored
""",
    "vocabulary": TRIPS + """
, names AS (
  SELECT DISTINCT 'PU_DO=' || pu_do AS feature FROM kept WHERE split = 'train'
  UNION SELECT 'trip_distance' FROM kept WHERE split = 'train'
)
SELECT feature, CAST(row_number() OVER (ORDER BY feature) - 1 AS INTEGER) AS index FROM names
""",
    "one_hot_long": TRIPS + """
, names AS (
  SELECT pu_do, row_number() OVER (ORDER BY pu_do) - 1 AS i
  FROM (SELECT DISTINCT pu_do FROM kept WHERE split = 'train')
)
SELECT event_id, CAST(i AS INTEGER) AS index, CAST(1 AS DOUBLE) AS value FROM kept JOIN names USING (pu_do)
UNION ALL
SELECT event_id, CAST((SELECT count(*) FROM names) AS INTEGER), trip_distance FROM kept WHERE trip_distance != 0
""",
    "one_hot_stages": TRIPS + """
, names AS (
  SELECT pu_do, row_number() OVER (ORDER BY pu_do) - 1 AS i
  FROM (SELECT DISTINCT pu_do FROM kept WHERE split = 'train')
)
SELECT event_id, CAST(i AS INTEGER) AS index, CAST(1 AS DOUBLE) AS value
FROM kept JOIN names USING (pu_do) WHERE split = 'test'
UNION ALL
SELECT event_id, CAST((SELECT count(*) FROM names) AS INTEGER), trip_distance
FROM kept WHERE split = 'test' AND trip_distance != 0
""",
    "feature_sets": TRIPS + """
SELECT split, count(DISTINCT (pu_code, do_code, trip_distance)) AS cells, count(*) AS trips,
       round(sum(duration), 6) AS label_sum FROM kept GROUP BY split
""",
    "ols_group_mean": MEANS + """
SELECT k.pu_code AS "PULocationID", round(coalesce(m, u), 7) AS prediction
FROM (SELECT DISTINCT pu_code FROM kept) k LEFT JOIN model USING (pu_code) CROSS JOIN unseen
""",
    "ols_numeric": TRIPS + """
SELECT count(*) AS n, round(regr_slope(duration, trip_distance), 6) AS slope,
       round(regr_intercept(duration, trip_distance), 6) AS intercept FROM kept WHERE split = 'train'
""",
    "ols_orthogonality": TRIPS + """
SELECT 'PULocationID=' || pu_code AS feature, count(*) AS n, round(sum(duration), 3) AS total FROM kept WHERE split = 'train' GROUP BY 1
UNION ALL
SELECT 'DOLocationID=' || do_code, count(*), round(sum(duration), 3) FROM kept WHERE split = 'train' GROUP BY 1
""",
    "ols_pair_distance": PAIR + "SELECT event_id, round(p, 6) AS prediction FROM scored",
    "tree_exact": TRIPS + _stumps("a", "SELECT event_id, 0 AS node, pu_code, do_code, split, duration AS y FROM kept") + """
SELECT event_id, round(p, 6) AS prediction FROM a_answers
""",
    "tree_split_limit": TRIPS + _stumps("a", "SELECT event_id, 0 AS node, pu_code, do_code, split, duration AS y FROM kept")
    + ", " + _stumps("b", "SELECT event_id, side AS node, pu_code, do_code, split, y FROM a_answers")[2:] + """
, sizes AS (SELECT side, count(*) AS n FROM a_answers WHERE split = 'train' GROUP BY side
)
SELECT event_id, round(b_answers.p, 6) AS prediction,
       round(CASE WHEN n < (SELECT sum(n) FROM sizes) // 2 THEN a_answers.p ELSE b_answers.p END, 6) AS limited
FROM a_answers JOIN b_answers USING (event_id) JOIN sizes ON sizes.side = a_answers.side
""",
    # A boosting round fits twice the residuals; the first tree counts in full, the others by the rate.
    "boost_exact": TRIPS + _stumps("a", "SELECT event_id, 0 AS node, pu_code, do_code, split, duration AS y FROM kept")
    + ", " + _stumps("b", "SELECT event_id, 0 AS node, pu_code, do_code, split, 2 * (y - p) AS y FROM a_answers")[2:] + """
SELECT event_id, round(a_answers.p, 6) AS one, round(a_answers.p + 0.09585355369315604::DOUBLE * b_answers.p, 6) AS two
FROM a_answers JOIN b_answers USING (event_id)
""",
    "pair_rmse_by_split": PAIR + """
SELECT split, count(*) AS n, round(sqrt(avg((duration - p) * (duration - p))), 6) AS rmse FROM scored GROUP BY split
""",
    "rmse_by_split": MEANS + """
SELECT split, count(*) AS n, round(sqrt(avg((duration - p) * (duration - p))), 3) AS rmse FROM kept_scored GROUP BY split
""",
    "prediction_histogram": MEANS + _histogram(
        """SELECT 'prediction' AS kind, round(p, 7) AS v FROM kept_scored WHERE split = 'test'
           UNION ALL SELECT 'duration', duration FROM kept_scored WHERE split = 'test'""",
        0.0,
        60.0,
        20,
    ),
    "active_runs": RUNS + "SELECT run_id, round(val_rmse, 6) AS rmse FROM runs WHERE status = 'active'",
    "leaderboard_topk": RUNS + """
SELECT run_id, round(val_rmse, 3) AS rmse FROM runs WHERE status = 'active' ORDER BY val_rmse, run_id LIMIT 3
""",
    "run_report": RUNS + """
SELECT run_id, 'params' AS kind, 'feature_set' AS name, s AS text, CAST(NULL AS DOUBLE) AS number FROM runs
UNION ALL SELECT run_id, 'metrics', 'rmse', NULL, round(val_rmse, 4) FROM runs
UNION ALL SELECT run_id, 'metrics', 'train_rmse', NULL, round(train_rmse, 4) FROM runs
UNION ALL SELECT run_id, 'metrics', 'val_rmse', NULL, round(val_rmse, 4) FROM runs
UNION ALL SELECT run_id, 'metrics', 'test_rmse', NULL, round(test_rmse, 4) FROM runs
""",
    "champion_challenger": RUNS + """
SELECT 'mean-models' AS experiment, run_id, round(test_rmse, 6) AS test_rmse,
       CASE place WHEN 1 THEN 'champion' ELSE 'challenger' END AS alias,
       CASE place WHEN 1 THEN 'approved' ELSE 'pending' END AS validation_status
FROM placed WHERE place <= 2
""",
    "promotion": RUNS + """
SELECT 'candidates' AS model, CASE place WHEN 1 THEN 'champion' ELSE 'challenger' END AS alias, run_id,
       CASE place WHEN 1 THEN 'approved' ELSE 'pending' END AS validation_status
FROM placed WHERE place <= 2
UNION ALL SELECT 'staging', 'staging_champion', run_id, 'approved' FROM placed WHERE place = 1
UNION ALL SELECT 'production', 'current', run_id, 'approved' FROM placed WHERE place = 1
""",
    "batch_score": MEANS + f"""
SELECT {_SOURCE_ID} AS ride_id, round(p, 7) AS predicted_duration, color AS taxi_type,
       CAST(year(pickup) AS INTEGER) AS year, CAST(month(pickup) AS INTEGER) AS month FROM kept_scored
""",
    "batch_score_dense": MEANS + f"""
SELECT {_DENSE_ID} AS ride_id, round(p, 7) AS predicted_duration FROM kept_scored
""",
    "batch_summary": MEANS + """
SELECT count(*) AS n, round(sum(p), 3) AS total, round(avg(p), 3) AS mean, round(stddev_pop(p), 3) AS std_population
FROM kept_scored
""",
    "batch_score_zones_exact": TRIPS + f"""
SELECT {_SOURCE_ID} AS ride_id,
       round(coalesce(CAST(CAST(pu AS BIGINT) % 12 AS DOUBLE) * 1.5, CAST(5 AS DOUBLE)) + CAST((dz % 10) * (dz % 10) AS DOUBLE) * 0.25, 6)
       AS predicted_duration
FROM kept
""",
    "ride_id_many_files": MEANS + f"""
SELECT {_SOURCE_ID} AS ride_id, round(p, 7) AS predicted_duration FROM kept_scored
""",
    "request_rejects": TRIPS + """
SELECT CASE event_id % 10 WHEN 1 THEN 'no JSON' WHEN 2 THEN 'no JSON' WHEN 3 THEN 'input missing' ELSE 'answered' END AS reason,
       count(*) AS n
FROM trips GROUP BY 1
""",
    "zones_exact": FOLDED + """
SELECT event_id, round(a + b, 6) AS prediction FROM folded WHERE split = 'test'
""",
    # Effects a and b of two islands k: n and m zones with means u and v. Of u + v the common part s moves
    # to the intercept; what is left is shared out so that the squares are least.
    "zone_islands": _ISLANDS,
    "zone_islands_tables": _ISLANDS,
    "zones_exact_tables": FOLDED + """
SELECT event_id, round(a + b, 6) AS prediction FROM folded WHERE split = 'test'
""",
    "ols_zones_distance": FOLDED + """
SELECT pu AS "PULocationID", dz AS "DOLocationID", count(*) AS n, round(avg(pu * 2.0::DOUBLE - dz + 1.75::DOUBLE * trip_distance), 7) AS prediction
FROM folded WHERE split = 'train' GROUP BY ALL
""",
    "alias_score": MEANS + "SELECT event_id, round(p, 7) AS prediction FROM kept_scored",
    "request_scores": MEANS + """
SELECT CAST(pu AS BIGINT) AS "PULocationID", 'run-1' AS model_version, count(*) AS n, round(max(p), 7) AS duration
FROM scored GROUP BY pu
""",
    "envelope_roundtrip": TRIPS + """
SELECT event_id AS ride_id, CAST(pu AS BIGINT) AS "PULocationID", dz AS "DOLocationID", trip_distance
FROM trips WHERE pu IS NOT NULL OR event_id % 4 = 3
""",
    "quarantine_split": TRIPS + """
SELECT event_id AS ride_id, CASE event_id % 4 WHEN 0 THEN 'not base64' ELSE 'no ride' END AS reason
FROM trips WHERE pu IS NULL AND event_id % 4 <> 3
UNION ALL SELECT NULL, 'no envelope' FROM (SELECT DISTINCT event_id // 100 FROM trips)
""",
    "prediction_events": MEANS + """
SELECT CAST(event_id AS VARCHAR) AS key, 'ride_duration_prediction_model' AS model, 'run-1' AS version,
       event_id AS ride_id, round(p, 7) AS ride_duration FROM scored WHERE pu IS NOT NULL OR event_id % 4 = 3
""",
    "stream_score": MEANS + """
SELECT 'ride_duration_prediction_model' AS model, 'run-1' AS version, event_id AS ride_id, round(p, 7) AS ride_duration
FROM scored WHERE pu IS NOT NULL OR event_id % 4 = 3
""",
    "stream_once": MEANS + """
SELECT event_id AS ride_id, round(p, 7) AS ride_duration FROM scored WHERE pu IS NOT NULL OR event_id % 4 = 3
""",
    "stream_windows": MEANS + """
SELECT strftime(TIMESTAMP '1970-01-01' + to_seconds(date_diff('second', TIMESTAMP '2024-01-01', pickup)), '%Y-%m-%d') AS day, count(*) AS n, round(avg(p), 6) AS mean
FROM scored WHERE pu IS NOT NULL OR event_id % 4 = 3 GROUP BY 1
""",
    "stream_promotion": MEANS + """
, other AS (SELECT do_code, avg(duration) AS m2 FROM kept WHERE split = 'train' GROUP BY do_code
), unseen2 AS (SELECT avg(m2) AS u2 FROM other
)
SELECT CASE event_id // 100 % 2 WHEN 0 THEN 'run-1' ELSE 'run-2' END AS version, event_id AS ride_id,
       round(CASE event_id // 100 % 2 WHEN 0 THEN p ELSE coalesce(m2, u2) END, 7) AS ride_duration
FROM scored LEFT JOIN other USING (do_code) CROSS JOIN unseen2 WHERE pu IS NOT NULL OR event_id % 4 = 3
""",
    "stream_messages": TRIPS + """
SELECT CASE WHEN pu IS NULL AND event_id % 4 <> 3 THEN 'held' ELSE 'sent' END AS sink, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum
FROM trips GROUP BY 1
""",
    "first_record": TRIPS + """
SELECT CAST(event_id AS VARCHAR) AS key, date_diff('second', TIMESTAMP '2024-01-01', pickup) AS arrival
FROM trips ORDER BY pickup, event_id LIMIT 1
""",
}
