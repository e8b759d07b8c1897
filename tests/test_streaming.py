import base64
import json

import pytest

from helpers import random_rides, trips
from kerbside.operators import train as models
from kerbside.operators.cells import collapse
from kerbside.operators.encode import PAIR_DISTANCE
from kerbside.operators.score import request_rejects, score_requests
from kerbside.streaming import records, service, sinks

EVENT = {"ride": {"PULocationID": 17, "DOLocationID": 88, "trip_distance": 2.25}, "ride_id": 4711}


def b64(value):
    text = value if isinstance(value, str) else json.dumps(value, indent=4)
    return base64.b64encode(text.encode()).decode()


def record(data, i=0):
    return {
        "kinesis": {
            "kinesisSchemaVersion": "1.0",
            "partitionKey": str(i),
            "sequenceNumber": str(i).zfill(8),
            "data": data,
            "approximateArrivalTimestamp": 1700000000.132 + i,
        },
        "eventSource": "aws:kinesis",
        "eventID": f"shard-0:{i}",
    }


def write(folder, *envelopes):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{len(list(folder.iterdir()))}.json").write_text("\n".join(json.dumps(e) for e in envelopes))
    return str(folder)


def test_decode(spark, tmp_path):
    path = write(tmp_path / "in", {"Records": [record(b64(EVENT))]}, {"Records": []})
    row = records.decode(records.read_envelopes(spark, path, streaming=False)).first()
    assert row.event.asDict(recursive=True) == EVENT
    assert row.event_id == "shard-0:0" and row.arrival.microsecond == 132000


def test_minimal_envelope_with_a_constant_model(spark, tmp_path):
    path = write(tmp_path / "in", {"Records": [{"kinesis": {"data": b64(EVENT)}}]})
    table = records.read_envelopes(spark, path, streaming=False)
    events = service.prediction_events(models.constant_model(10.0), table, "test1")
    expected = {"model": "ride_duration_prediction_model", "version": "test1", "prediction": {"ride_duration": 10.0, "ride_id": 4711}}
    assert [r.asDict(recursive=True) for r in events.collect()] == [expected]
    message = records.messages(events).first()
    assert message.key == "4711" and json.loads(message.value) == expected
    unversioned = records.messages(service.prediction_events(models.constant_model(10.0), table, None)).first()
    assert json.loads(unversioned.value) == {**expected, "version": None}


def test_bad_records_are_set_aside(spark, tmp_path):
    ride = {"PULocationID": 1, "DOLocationID": 3, "trip_distance": None}
    bad = ["!!bad", b64("no json"), b64({"ride_id": 3}), b64({"ride": EVENT["ride"]}), b64({"ride": ride, "ride_id": 5}), None]
    path = write(tmp_path / "in", {"Records": [record(d, i) for i, d in enumerate([*bad, b64(EVENT)])]})
    decoded = records.decode(records.read_envelopes(spark, path, streaming=False))
    inputs = PAIR_DISTANCE.inputs
    found = {r.event_id: r.reason for r in records.rejects(decoded, inputs).collect()}
    assert list(found.values()) == ["not base64", "no ride", "no ride", "no ride id", "input missing", "not base64"]
    assert [r.ride_id for r in records.rides(decoded, inputs).collect()] == [4711]


@pytest.fixture(scope="module")
def model(spark):
    return models.fit(collapse(trips(spark, random_rides(300)), PAIR_DISTANCE).filter("split = 'train'"), PAIR_DISTANCE)


def test_stream_publishes_to_all_sinks_once(spark, model, tmp_path):
    rides = [{"ride": {"PULocationID": i % 7, "DOLocationID": i % 4, "trip_distance": i / 2}, "ride_id": i} for i in range(40)]
    folder = tmp_path / "in"
    seen = []

    def user_sink(events, batch_id):
        seen.extend(r.prediction.ride_id for r in events.collect())

    def drain():
        query = service.start(
            model,
            records.read_envelopes(spark, str(folder), maxFilesPerTrigger="1"),
            "run-7",
            [sinks.parquet_sink(f"{tmp_path}/events"), sinks.message_sink(f"{tmp_path}/messages"), user_sink],
            f"{tmp_path}/checkpoint",
            sinks.parquet_sink(f"{tmp_path}/rejects"),
            {"availableNow": True},
        )
        query.awaitTermination()

    write(folder, {"Records": [record(b64(r), r["ride_id"]) for r in rides[:10]]})
    write(folder, {"Records": [record("!!bad", 99)] + [record(b64(r), r["ride_id"]) for r in rides[10:20]]})
    drain()
    write(folder, {"Records": [record(b64(r), r["ride_id"]) for r in rides[20:]]})
    drain()

    events = sinks.read_events(spark, f"{tmp_path}/events").collect()
    assert sorted(e.prediction.ride_id for e in events) == sorted(seen) == list(range(40))
    assert {e.version for e in events} == {"run-7"} and {e.batch_id for e in events} == {0, 1, 2}
    sent = {m.key: json.loads(m.value) for m in sinks.read_messages(spark, f"{tmp_path}/messages").collect()}
    assert sent == {
        str(e.prediction.ride_id): {"model": e.model, "version": e.version, "prediction": e.prediction.asDict()} for e in events
    }
    assert [r.reason for r in spark.read.parquet(f"{tmp_path}/rejects").collect()] == ["not base64"]

    # The batch path gives every ride the same answer.
    requests = write(tmp_path / "requests", *[{**r["ride"], "ride_id": r["ride_id"]} for r in rides])
    table = spark.read.schema("PULocationID BIGINT, DOLocationID BIGINT, trip_distance DOUBLE, ride_id BIGINT").json(requests)
    batch = {r.ride_id: r.duration for r in score_requests(model, table).collect()}
    assert batch == {e.prediction.ride_id: e.prediction.ride_duration for e in events}
    assert len(set(batch.values())) > 10


def test_replayed_batch_overwrites_itself(spark, tmp_path):
    path = write(tmp_path / "in", {"Records": [record(b64(EVENT))]})
    events = service.prediction_events(models.constant_model(1.0), records.read_envelopes(spark, path, streaming=False), "v")
    for _ in range(2):
        sinks.parquet_sink(f"{tmp_path}/out")(events, 3)
        sinks.message_sink(f"{tmp_path}/text")(events, 3)
    assert sinks.read_events(spark, f"{tmp_path}/out").count() == 1
    assert sinks.read_messages(spark, f"{tmp_path}/text").count() == 1


def test_dry_run_keeps_events_in_memory(spark, model, tmp_path):
    path = write(tmp_path / "in", {"Records": [record(b64(EVENT))]})
    query = service.dry_run(model, records.read_envelopes(spark, path), "v", "dry")
    query.awaitTermination()
    row = spark.table("dry").first()
    assert row.prediction.ride_id == 4711 and row.prediction.ride_duration > 0


def test_single_requests(spark, model, tmp_path):
    path = write(tmp_path / "in", EVENT["ride"], {**EVENT["ride"], "trip_distance": 1.0})
    answers = score_requests(model, records.read_requests(spark, path), "r").collect()
    assert len(answers) == 2 and answers[0].duration != answers[1].duration
    stream = score_requests(model, records.read_requests(spark, path, streaming=True), "r")
    query = stream.writeStream.format("memory").queryName("answers").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("answers").count() == 2


def test_pack_is_bounded_and_inverse_to_decode(spark):
    table = spark.range(250).selectExpr(
        "id", "id % 7 AS PULocationID", "id % 3 AS DOLocationID", "id / 2 AS trip_distance", "cast(id as double) AS arrival"
    )
    packed = records.pack(table, "id", "arrival", 100)
    assert sorted(len(r.Records) for r in packed.collect()) == [50, 100, 100]
    rides = records.rides(records.decode(packed), ["PULocationID"])
    assert sorted((r.ride_id, r.PULocationID, r.DOLocationID, r.trip_distance) for r in rides.collect()) == sorted(
        (r.id, r.PULocationID, r.DOLocationID, r.trip_distance) for r in table.collect()
    )


def test_cut_off_lines_go_to_quarantine(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    good = json.dumps({"Records": [record(b64(EVENT), 1)]})
    (folder / "0.json").write_text("\n".join([good, good[:90], "no json at all", "{}", json.dumps({"Records": []}), json.dumps({"Records": None})]))
    decoded = records.decode(records.read_envelopes(spark, str(folder), streaming=False))
    held = records.rejects(decoded, PAIR_DISTANCE.inputs).collect()
    assert [r.reason for r in held] == ["no envelope"] * 4
    assert {r.data for r in held} == {good[:90], "no json at all", None}
    assert records.rides(decoded, PAIR_DISTANCE.inputs).count() == 1


def test_a_ride_without_a_zone_gets_one_answer_everywhere(spark, model, tmp_path):
    ride = {"PULocationID": None, "DOLocationID": 3, "trip_distance": 1.5}
    table = spark.createDataFrame([(None, 3, 1.5)], "PULocationID BIGINT, DOLocationID BIGINT, trip_distance DOUBLE")
    batch = models.predict(model, table).first().prediction
    asked = score_requests(model, table).first().duration
    path = write(tmp_path / "in", {"Records": [record(b64({"ride": ride, "ride_id": 5}))]})
    event = service.prediction_events(model, records.read_envelopes(spark, path, streaming=False), None).first()
    assert batch == asked == event.prediction.ride_duration


def test_requests_that_are_no_json_are_refused(spark, model, tmp_path):
    folder = tmp_path / "requests"
    folder.mkdir()
    lines = [{"PULocationID": 1, "DOLocationID": 2, "trip_distance": 1.0}, {"PULocationID": 1}, {"trip_distance": 2.0}]
    (folder / "0.json").write_text("\n".join([*map(json.dumps, lines), "not json", '{"PULocationID": 1, "trip_']))
    requests = records.read_requests(spark, str(folder))
    assert sorted(r.trip_distance for r in score_requests(model, requests).collect()) == [1.0, 2.0]
    reasons = sorted(r.reason for r in request_rejects(model, requests).collect())
    assert reasons == ["input missing", "no JSON", "no JSON"]


DAY = 86_400


def timed(ride_id, arrival):
    entry = record(b64({**EVENT, "ride_id": ride_id}), ride_id)
    entry["kinesis"]["approximateArrivalTimestamp"] = float(arrival)
    return entry


def test_repeats_are_scored_once_and_records_without_id_all(spark, tmp_path):
    nameless = {k: v for k, v in timed(9, 5 * DAY).items() if k != "eventID"}
    path = write(tmp_path / "in", {"Records": [timed(1, 5 * DAY), timed(1, 5 * DAY), timed(2, 5 * DAY), nameless, nameless]})

    def drain():
        stream = records.read_envelopes(spark, path, maxFilesPerTrigger="1")
        run = service.start(models.constant_model(3.0), stream, "v", [sinks.parquet_sink(f"{tmp_path}/out")], f"{tmp_path}/check", None, {"availableNow": True}, "1 day")
        run.awaitTermination()
        found = sinks.read_events(spark, f"{tmp_path}/out").select("prediction.ride_id").collect()
        return sorted(r.ride_id for r in found), service.late(run)

    assert drain() == ([1, 2, 9, 9], 0)
    # From the checkpoint: one known, one new, and one that is later than the watermark.
    write(tmp_path / "in", {"Records": [timed(2, 5 * DAY), timed(3, 6 * DAY)]})
    assert drain()[0] == [1, 2, 3, 9, 9]
    write(tmp_path / "in", {"Records": [timed(4, 1 * DAY)]})
    assert drain() == ([1, 2, 3, 9, 9], 1)


def test_windows_take_late_records_until_the_watermark(spark, tmp_path):
    path = write(tmp_path / "in", {"Records": [timed(k, 5 * DAY + k) for k in range(4)]})

    def drain():
        stream = records.read_envelopes(spark, path, maxFilesPerTrigger="1")
        run = service.start_windows(models.constant_model(3.0), stream, f"{tmp_path}/out", f"{tmp_path}/check", "1 day", "2 days", {"availableNow": True})
        run.awaitTermination()
        return sorted((int(r.start.timestamp()) // DAY, r.n, r["mean"]) for r in service.read_windows(spark, f"{tmp_path}/out").collect()), service.late(run)

    assert drain() == ([(5, 4, 3.0)], 0)
    write(tmp_path / "in", {"Records": [timed(20, 4 * DAY), timed(21, 5 * DAY)]})
    assert drain() == ([(4, 1, 3.0), (5, 5, 3.0)], 0)
    write(tmp_path / "in", {"Records": [timed(30, 9 * DAY)]})
    drain()
    write(tmp_path / "in", {"Records": [timed(31, 2 * DAY)]})
    found, dropped = drain()
    assert found == [(4, 1, 3.0), (5, 5, 3.0), (9, 1, 3.0)] and dropped == 1
