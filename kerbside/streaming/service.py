"""The stream scorer: envelopes in, prediction events out to any number of sinks.

Each micro-batch is decoded and scored once, as a whole, and split into events and rejects for the
sinks. Delivery is at least once: folder sinks write per batch and overwrite on replay,
a topic may get a batch twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbside.operators import registry
from kerbside.operators.train import Trained, load, model_location, predict
from kerbside.streaming import records

Sink = Callable[[DataFrame, int], None]
Scorers = Callable[[], tuple[Trained | PipelineModel, str]]


def inputs_of(model: Trained | PipelineModel) -> list[str]:
    return model.spec.inputs if isinstance(model, Trained) else []


def prediction_events(model: Trained | PipelineModel, envelopes: DataFrame, version: str | None) -> DataFrame:
    """Stateless scoring of all usable records; for a table or, without sinks, for a stream."""
    rides = records.rides(records.decode(envelopes), inputs_of(model))
    return records.events(predict(model, rides), version)


def start(
    model: Trained | PipelineModel | Scorers,
    envelopes: DataFrame,
    version: str | None,
    sinks: Sequence[Sink],
    checkpoint: str,
    quarantine: Sink | None = None,
    trigger: Mapping | None = None,
    repeats_within: str | None = None,
) -> StreamingQuery:
    """Score a stream until stopped, or (`trigger={"availableNow": True}`) until it is drained.

    The model is loaded by the caller, once; or `model` is a function that gives the model and its version,
    asked at the border of every batch (see `by_alias`). With no sinks nothing is published; `dry_run`
    shows the events instead. With `repeats_within` records that are delivered again within that time
    are scored once.
    """
    fixed = None if callable(model) and not isinstance(model, (Trained, PipelineModel)) else (model, version)

    def publish(batch: DataFrame, batch_id: int) -> None:
        # One pass parses and scores the batch. What is kept for the sinks is small: id and
        # prediction of good records, the payload of bad ones only.
        scorer, version = fixed or model()
        judged = records.judged(batch if repeats_within else records.decode(batch), inputs_of(scorer))
        scored = predict(scorer, judged).select("event_id", "arrival", "ride_id", "prediction", "reason", "data")
        outputs = len(sinks) + (quarantine is not None)
        if outputs > 1:
            scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for sink in sinks:
                sink(records.events(scored.filter("reason IS NULL"), version), batch_id)
            if quarantine:
                quarantine(records.rejected(scored), batch_id)
        finally:
            if outputs > 1:
                scored.unpersist()

    stream = records.once(records.decode(envelopes), repeats_within) if repeats_within else envelopes
    writer = stream.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def dry_run(model: Trained | PipelineModel, envelopes: DataFrame, version: str | None, name: str) -> StreamingQuery:
    """Publish nothing and keep the events in the driver's table `name` (for small trials)."""
    events = prediction_events(model, envelopes, version)
    return events.writeStream.format("memory").queryName(name).trigger(availableNow=True).start()


def by_alias(spark: SparkSession, root: str, experiment: str, model: str, alias: str) -> Scorers:
    """The model that the alias names when a batch begins, with its run id as version. A model is loaded when the
    alias first names it."""
    loaded: dict[str, Trained] = {}

    def current() -> tuple[Trained, str]:
        run_id = registry.run_by_alias(registry.read_aliases(spark, f"{root}/aliases"), model, alias)
        if run_id not in loaded:
            loaded.clear()
            loaded[run_id] = load(spark, model_location(run_id, root, experiment=experiment))
        return loaded[run_id], run_id

    return current


def start_windows(
    model: Trained | PipelineModel, envelopes: DataFrame, path: str, checkpoint: str, width: str, late_by: str, trigger: Mapping | None = None
) -> StreamingQuery:
    """Means of the predictions by window of arrival, to a folder for each batch with the windows that it changed;
    `read_windows` has their last state."""
    rides = records.rides(records.decode(envelopes), inputs_of(model))
    means = records.window_means(predict(model, rides), width, late_by)

    def write(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = means.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """The last state of every window."""
    found = spark.read.schema("start TIMESTAMP, end TIMESTAMP, n BIGINT, mean DOUBLE, batch_id BIGINT").parquet(path)
    return found.groupBy("start", "end").agg(F.max_by("n", "batch_id").alias("n"), F.max_by("mean", "batch_id").alias("mean"))


def late(query: StreamingQuery) -> int:
    """Records that came too late for a stateful step, as far as the query's progress is kept."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
