"""Sinks for micro-batches. A sink is any `f(events, batch_id)`; these are the usual ones."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from kerbside.functions.codec import PREDICTION_EVENT
from kerbside.streaming.records import messages

Sink = Callable[[DataFrame, int], None]


def parquet_sink(path: str) -> Sink:
    """One folder per batch; a replayed batch overwrites its own folder."""

    def write(table: DataFrame, batch_id: int) -> None:
        table.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def message_sink(path: str) -> Sink:
    """Keyed JSON messages as JSON lines, one folder per batch."""

    def write(events: DataFrame, batch_id: int) -> None:
        messages(events).write.mode("overwrite").json(f"{path}/batch_id={batch_id}")

    return write


def topic_sink(options: Mapping[str, str]) -> Sink:
    """Keyed JSON messages to Kafka. `options` name the servers (real or a local double) and topic.

    A replayed batch is sent again: consumers tell repeats by the key.
    """

    def write(events: DataFrame, batch_id: int) -> None:
        messages(events).write.format("kafka").options(**options).save()

    return write


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{PREDICTION_EVENT}, batch_id INT").parquet(path)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("key STRING, value STRING, batch_id INT").json(path)
