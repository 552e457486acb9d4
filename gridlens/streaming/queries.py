"""Streaming queries: start, wait, measure."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from gridlens.operators.alerts import latest_per_key, merge_alerts
from gridlens.streaming import alert_store

LIVE_ANOMALIES = {"processingTime": "5 seconds"}
LIVE_ALERTS = {"processingTime": "10 seconds"}
DRAIN = {"availableNow": True}
VERSION = "batch_id"


def stream_to_parquet(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append a stream to Parquet, exactly once."""
    return (
        df.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or LIVE_ANOMALIES)).start()
    )


def alerts_as_messages(alerts: DataFrame) -> DataFrame:
    return alerts.select(F.col("DISTRITO").cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def stream_alerts_to_kafka(alerts: DataFrame, servers: str, topic: str, checkpoint: str,
                           trigger: dict | None = None) -> StreamingQuery:
    """Closed windows as keyed messages. Needs the Kafka connector on the classpath."""
    return (
        alerts_as_messages(alerts).writeStream.format("kafka").outputMode("append")
        .option("kafka.bootstrap.servers", servers).option("topic", topic)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or LIVE_ALERTS)).start()
    )


def foreach_batch(df: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
                  trigger: dict | None = None) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(work).outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or LIVE_ALERTS)).start()
    )


def classify_batches(df: DataFrame, classify: Callable[[DataFrame], DataFrame], folder: str, checkpoint: str,
                     trigger: dict | None = None) -> StreamingQuery:
    """Classify each micro-batch and store it under its batch id, so a replayed batch replaces itself."""
    def work(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            classify(batch).write.mode("overwrite").parquet(f"{folder}/{VERSION}={batch_id}")

    return foreach_batch(df, work, checkpoint, "append", trigger or LIVE_ANOMALIES)


def log_alert_updates(alerts: DataFrame, folder: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Store the windows each micro-batch changed; ``current_alerts`` reads their latest state.

    The log keeps every update. ``upsert_alerts`` rewrites them into one table instead.
    """
    def work(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/{VERSION}={batch_id}")

    return foreach_batch(alerts, work, checkpoint, "update", trigger)


def current_alerts(spark: SparkSession, folder: str) -> DataFrame:
    updates = spark.read.option("basePath", folder).parquet(folder)
    return latest_per_key(updates, VERSION)


def upsert_alerts(alerts: DataFrame, folder: str, checkpoint: str, keep: int | None = None,
                  trigger: dict | None = None) -> StreamingQuery:
    """Keep one table of all alerts in their latest state; ``latest_alerts`` cuts it on read.

    All alerts are stored by day, and a micro-batch rewrites the days it touches (``alert_store``). A table of the newest
    ``keep`` is small and is rewritten whole, in two slots that take turns: a micro-batch merges the slot of the batch before
    into its own. Either way a replayed batch finds its input unchanged. Folder and checkpoint belong together.
    """
    def work(batch: DataFrame, batch_id: int) -> None:
        if keep is None:
            alert_store.merge_batch(batch, folder, batch_id)
            return
        stored = _slot(batch.sparkSession, folder, batch_id - 1)
        stored = batch.limit(0) if stored is None else stored.drop(VERSION)
        merged = merge_alerts(stored, batch, keep).withColumn(VERSION, F.lit(batch_id).cast("bigint"))
        merged.write.mode("overwrite").parquet(_slot_path(folder, batch_id))

    return foreach_batch(alerts, work, checkpoint, "update", trigger)


def _slot_path(folder: str, batch_id: int) -> str:
    return f"{folder}/slot-{batch_id % 2}"


def _slot(spark: SparkSession, folder: str, batch_id: int) -> DataFrame | None:
    try:
        return spark.read.parquet(_slot_path(folder, batch_id))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def stored_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """The table written by ``upsert_alerts``."""
    try:
        versions = spark.read.parquet(f"{folder}/slot-*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return alert_store.read_alerts(spark, folder)
    return versions.filter(F.col(VERSION) == versions.agg(F.max(VERSION)).scalar()).drop(VERSION)


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query that processes what is available and then ends."""
    query.awaitTermination()
    return query


def run_bounded(queries: Iterable[StreamingQuery], seconds: float = 300) -> float | None:
    """Let live queries run, then stop them all. Returns the first one's mean micro-batch seconds."""
    first, *others = running = list(queries)
    try:
        first.awaitTermination(seconds)
        return mean_latency(first)
    finally:
        for query in running:
            query.stop()


def mean_latency(query: StreamingQuery) -> float | None:
    """Mean micro-batch duration over the recent progress, in seconds."""
    spent = [p.durationMs.get("triggerExecution") for p in query.recentProgress]
    spent = [ms for ms in spent if ms is not None]
    return sum(spent) / len(spent) / 1000 if spent else None
