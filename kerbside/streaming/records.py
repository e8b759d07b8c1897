"""Delivered records to ride events, and back. Works the same on a table and on a stream."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.codec import CORRUPT, RIDE, USED_ENVELOPE, encode_event, event_json, parse_event, payload_text, prediction_event
from kerbside.functions.columns import ZONE_COLUMNS


def read_envelopes(
    spark: SparkSession, path: str, streaming: bool = True, schema: str = USED_ENVELOPE, **options: str
) -> DataFrame:
    """Envelopes from a folder of JSON lines. A stream replays the folder from its first file.

    `schema` may be the full ENVELOPE; by default only the fields that scoring uses are parsed. Lines
    that cannot be read are kept as text for the quarantine.
    """
    return _json_lines(spark, schema, streaming).options(**options).json(path)


def _json_lines(spark: SparkSession, schema: str, streaming: bool):
    reader = spark.readStream if streaming else spark.read
    return reader.schema(f"{schema}, {CORRUPT} STRING").option("columnNameOfCorruptRecord", CORRUPT)


def read_topic(spark: SparkSession, options: Mapping[str, str], streaming: bool = True) -> DataFrame:
    """Records from Kafka as envelopes of one record each, earliest first unless told otherwise.

    Needs the Kafka connector on the class path. The payload is the base64 text, as in envelopes.
    """
    reader = spark.readStream if streaming else spark.read
    topic = reader.format("kafka").options(**{"startingOffsets": "earliest", **options}).load()
    record = F.struct(
        F.struct(
            F.col("key").cast("string").alias("partitionKey"),
            F.concat_ws(":", "partition", "offset").alias("sequenceNumber"),
            F.col("value").cast("string").alias("data"),
            F.col("timestamp").cast("double").alias("approximateArrivalTimestamp"),
        ).alias("kinesis"),
        F.concat_ws(":", "topic", "partition", "offset").alias("eventID"),
    )
    return topic.select(F.array(record).alias("Records"))


def read_requests(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Single rides as JSON lines; lines that cannot be read are kept as text."""
    return _json_lines(spark, RIDE, streaming).json(path)


def explode_records(envelopes: DataFrame) -> DataFrame:
    """One row per record, and one for each line that holds no envelope: `broken`, with the line if known."""
    line = F.col(CORRUPT) if CORRUPT in envelopes.columns else F.lit(None).cast("string")
    broken = line.isNotNull() | F.col("Records").isNull()
    nothing = F.array(F.lit(None).cast(envelopes.schema["Records"].dataType.elementType))
    delivered = F.explode(F.when(broken, nothing).otherwise(F.col("Records"))).alias("record")
    return envelopes.select(delivered, broken.alias("broken"), line.alias("line")).select("record.*", "broken", "line")


def decode(envelopes: DataFrame) -> DataFrame:
    """One row per record (or broken envelope): payload text and the parsed event."""
    records = explode_records(envelopes).select(
        "broken",
        F.col("eventID").alias("event_id"),
        F.col("kinesis.partitionKey").alias("partition_key"),
        F.timestamp_seconds("kinesis.approximateArrivalTimestamp").alias("arrival"),
        F.coalesce("kinesis.data", "line").alias("data"),
    )
    return records.withColumn("payload", payload_text(F.col("data"))).withColumn("event", parse_event(F.col("payload")))


def once(decoded: DataFrame, within: str) -> DataFrame:
    """Each record of a stream once, however often it is delivered within this time of its first arrival.

    The state store holds the ids of that time. A record that comes later than the watermark, the latest
    arrival less `within`, is dropped as a repeat would be (`late` counts these); records without id cannot
    be told apart and all stay.
    """
    named = decoded.withColumn("arrival", F.coalesce("arrival", F.current_timestamp()))
    named = named.withColumn("_id", F.coalesce("event_id", F.concat(F.lit("none:"), F.uuid())))
    return named.withWatermark("arrival", within).dropDuplicatesWithinWatermark(["_id"]).drop("_id")


def reject_reason(inputs: list[str]):
    """Why a record cannot be scored; null when it can.

    A usable record parses to a ride with an id and all numbers the model takes. A missing zone is no
    fault: it is the unknown zone, as in batch scoring and requests.
    """
    missing = [F.col(f"event.ride.{name}").isNull() for name in inputs if name not in ZONE_COLUMNS]
    return (
        F.when(F.col("broken"), "no envelope")
        .when(F.col("payload").isNull(), "not base64")
        .when(F.col("event.ride").isNull(), "no ride")
        .when(F.col("event.ride_id").isNull(), "no ride id")
        .when(reduce(or_, missing, F.lit(False)), "input missing")
    )


def judged(decoded: DataFrame, inputs: list[str]) -> DataFrame:
    """Every record with its ride columns and its reject reason; only rejects keep their payload.

    Numbers missing in a reject read 0, so that good and bad records pass the model together.
    """
    reason = reject_reason(inputs)
    return decoded.select(
        "event_id",
        "arrival",
        "event.ride.PULocationID",
        "event.ride.DOLocationID",
        F.when(reason.isNotNull(), F.coalesce("event.ride.trip_distance", F.lit(0.0)))
        .otherwise(F.col("event.ride.trip_distance"))
        .alias("trip_distance"),
        "event.ride_id",
        reason.alias("reason"),
        F.when(reason.isNotNull(), F.col("data")).alias("data"),
    )


def rides(decoded: DataFrame, inputs: list[str]) -> DataFrame:
    return decoded.filter(reject_reason(inputs).isNull()).select("event_id", "arrival", "event.ride.*", "event.ride_id")


def rejects(decoded: DataFrame, inputs: list[str]) -> DataFrame:
    """Records that cannot be scored, with the step that failed. Nothing is lost, nothing is scored."""
    return rejected(judged(decoded, inputs))


def rejected(records: DataFrame) -> DataFrame:
    return records.filter("reason IS NOT NULL").select("event_id", "arrival", "data", "reason")


def events(scored: DataFrame, version: str | None) -> DataFrame:
    event = prediction_event(F.col("prediction"), F.col("ride_id"), F.lit(version))
    return scored.select(event.alias("e")).select("e.*")


def window_means(scored: DataFrame, width: str, late_by: str) -> DataFrame:
    """Running count and mean of the predictions of a stream in windows of arrival time; a window takes records
    until the watermark has passed its end."""
    seen = scored.withWatermark("arrival", late_by)
    means = seen.groupBy(F.window("arrival", width)).agg(F.count("prediction").alias("n"), F.avg("prediction").alias("mean"))
    return means.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n", "mean")


def messages(prediction_events: DataFrame) -> DataFrame:
    """Key and JSON value, one message per ride, keyed by ride."""
    key = F.col("prediction.ride_id").cast("string")
    return prediction_events.select(
        key.alias("key"), event_json(F.struct("model", "version", "prediction")).alias("value")
    )


def pack(trips: DataFrame, ride_id: str, arrival: str, size: int = 100) -> DataFrame:
    """Trips as envelopes of at most `size` records (the inverse of `decode`).

    The id range decides the envelope, so a group never holds more than `size` rows.
    """
    ride = F.struct("PULocationID", "DOLocationID", "trip_distance")
    record = F.struct(
        F.struct(
            F.lit("1.0").alias("kinesisSchemaVersion"),
            F.col(ride_id).cast("string").alias("partitionKey"),
            F.lpad(F.col(ride_id).cast("string"), 20, "0").alias("sequenceNumber"),
            encode_event(ride, F.col(ride_id)).alias("data"),
            F.col(arrival).alias("approximateArrivalTimestamp"),
        ).alias("kinesis"),
        F.lit("aws:kinesis").alias("eventSource"),
        F.concat(F.lit("shard-0:"), F.col(ride_id).cast("string")).alias("eventID"),
    )
    batches = trips.select(F.floor(F.col(ride_id) / size).alias("batch"), record.alias("record"))
    return batches.groupBy("batch").agg(F.collect_list("record").alias("Records")).select("Records")
