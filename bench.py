"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and three times for the median. Results are written to the no-op
sink, so every row and column is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from kerbside.plans.catalog import QUERIES  # noqa: E402
from kerbside.session import build_session  # noqa: E402

HEADLINES = [
    "trips_kept",
    "duration_stats",
    "monthly_duration_stats",
    "next_month_rmse",
    "feature_sets",
    "vocabulary",
    "one_hot_long",
    "ride_id_source",
    "ride_id_dense",
    "ols_group_mean",
    "ols_pair_distance",
    "rmse_by_split",
    "leaderboard_topk",
    "batch_score_zones",
    "batch_score",
    "alias_score",
    "stream_score",
    "forest_score",
    "gbt_score",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    for _ in range(3):  # let the JVM compile the scan path, or the first query pays for all
        QUERIES[names[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
            spark.catalog.clearCache()  # every run starts from the files
        seconds[name] = round(statistics.median(runs[1:]), 3)
    spark.stop()
    result = {
        "metric": "total seconds of headline queries (median of 3 after a warm-up)",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
