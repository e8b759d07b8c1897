from datetime import datetime, timedelta

YELLOW_TIMES = ("tpep_pickup_datetime", "tpep_dropoff_datetime")
TRIP = (
    "pickup_datetime TIMESTAMP_NTZ, dropoff_datetime TIMESTAMP_NTZ, PULocationID BIGINT, DOLocationID BIGINT, "
    "trip_distance DOUBLE, split STRING"
)


def raw_rides(spark, *rides, zones="DOUBLE", times=YELLOW_TIMES):
    """Raw trips from (pickup zone, drop-off zone, pickup, drop-off), the times as text."""
    pickup, dropoff = times
    text = spark.createDataFrame(rides, f"PULocationID {zones}, DOLocationID {zones}, {pickup} STRING, {dropoff} STRING")
    return text.withColumns({c: text[c].cast("timestamp_ntz") for c in times})


def trip(minutes, pu=1, do=2, distance=1.0, split="train"):
    start = datetime.fromisoformat("2023-01-01T08:00")
    return (start, start + timedelta(minutes=minutes), pu, do, distance, split)


def trips(spark, rows):
    from kerbside.operators.prepare import with_duration

    return with_duration(spark.createDataFrame(rows, TRIP))


def random_rides(n, seed=0, zones=(6, 4), distances=8):
    """Rides with uneven zones, missing zones and repeated distances."""
    import numpy as np

    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        pu = int(rng.choice(zones[0], p=None if rng.random() > 0.33 else _hot(zones[0])))
        do = int(rng.integers(zones[1]))
        distance = float(rng.integers(1, distances)) / 2
        minutes = 5 + 3 * pu + 2 * do + 1.5 * distance + float(rng.normal(0, 2))
        split = ("train", "val", "test")[int(rng.integers(3))]
        rows.append(trip(max(1.0, min(60.0, minutes)), None if pu == 0 else pu, do, distance, split))
    return rows


def _hot(n):
    return [1.0 if i == 1 else 0.0 for i in range(n)]
