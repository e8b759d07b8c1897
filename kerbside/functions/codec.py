"""Ride events, their transport encoding and the prediction events sent back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RIDE = "PULocationID BIGINT, DOLocationID BIGINT, trip_distance DOUBLE"
RIDE_EVENT = f"ride STRUCT<{RIDE}>, ride_id BIGINT"
RECORD = (
    "kinesis STRUCT<kinesisSchemaVersion STRING, partitionKey STRING, sequenceNumber STRING, "
    "data STRING, approximateArrivalTimestamp DOUBLE>, eventSource STRING, eventVersion STRING, "
    "eventID STRING, eventName STRING, invokeIdentityArn STRING, awsRegion STRING, eventSourceARN STRING"
)
# What scoring reads of a record; a reader given this schema skips the other fields.
USED_RECORD = "kinesis STRUCT<partitionKey STRING, data STRING, approximateArrivalTimestamp DOUBLE>, eventID STRING"
USED_ENVELOPE = f"Records ARRAY<STRUCT<{USED_RECORD}>>"
ENVELOPE = f"Records ARRAY<STRUCT<{RECORD}>>"
# Where JSON readers leave a line that is no JSON, or is cut off.
CORRUPT = "_corrupt"
PREDICTION_EVENT = "model STRING, version STRING, prediction STRUCT<ride_duration DOUBLE, ride_id BIGINT>"

# Fixed value: the model name consumers of the prediction events look for.
MODEL_NAME = "ride_duration_prediction_model"


def payload_text(data: Column) -> Column:
    """Base64 text to UTF-8 text; null when it is not base64 (`unbase64` would decode junk)."""
    return F.try_to_binary(data, F.lit("base64")).cast("string")


def parse_event(text: Column) -> Column:
    return F.from_json(text, RIDE_EVENT)


def encode_event(ride: Column, ride_id: Column) -> Column:
    event = F.struct(ride.alias("ride"), ride_id.alias("ride_id"))
    # Some settings make base64() break its text into lines.
    return F.regexp_replace(F.base64(F.to_json(event, {"ignoreNullFields": "false"}).cast("binary")), "\\s", "")


def prediction_event(prediction: Column, ride_id: Column, version: Column, name: str = MODEL_NAME) -> Column:
    return F.struct(
        F.lit(name).alias("model"),
        version.cast("string").alias("version"),
        F.struct(
            prediction.cast("double").alias("ride_duration"),
            ride_id.alias("ride_id"),
        ).alias("prediction"),
    )


def event_json(event: Column) -> Column:
    """JSON that keeps a null version (Spark drops null fields by default)."""
    return F.to_json(event, {"ignoreNullFields": "false"})
