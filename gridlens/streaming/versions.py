"""Tables under version numbers, so that a running stream takes up what the batch layer publishes.

A version is written first and listed afterwards, so a reader never sees half of one. A micro-batch pins the version it begins
with under its batch id; run again, it uses the same one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from gridlens.streaming.queries import LIVE_ANOMALIES, VERSION, foreach_batch

LIST = "version bigint"


def _newest(spark: SparkSession, path: str) -> int | None:
    try:
        return spark.read.schema(LIST).parquet(path).agg(F.max("version")).first()[0]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def publish(table: DataFrame, folder: str) -> int:
    """Store a table as the next version. One publisher at a time; a version that was begun and not listed is written over."""
    spark = table.sparkSession
    version = (latest(spark, folder) or 0) + 1
    table.write.mode("overwrite").parquet(f"{folder}/tables/{version}")
    spark.range(1).select(F.lit(version).cast("bigint").alias("version")).coalesce(1).write.mode("append").parquet(f"{folder}/listed")
    return version


def latest(spark: SparkSession, folder: str) -> int | None:
    return _newest(spark, f"{folder}/listed")


def read_version(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{folder}/tables/{version}")


def pinned(spark: SparkSession, folder: str, pins: str, batch_id: int) -> int:
    """The version that a micro-batch uses: the newest when it first ran."""
    path = f"{pins}/{batch_id}"
    version = _newest(spark, path)
    if version is None:
        version = latest(spark, folder)
        if version is None:
            raise FileNotFoundError(f"nothing is published in {folder}")
        spark.range(1).select(F.lit(version).cast("bigint").alias("version")).coalesce(1).write.mode("overwrite").parquet(path)
    return version


def with_versions(events: DataFrame, folder: str, work: Callable[[DataFrame, DataFrame], DataFrame], out: str, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """``work(micro-batch, table)`` for each micro-batch with the newest version of the table, stored under the batch id. Each
    row says which version it was made with."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version = pinned(spark, folder, f"{checkpoint}-versions", batch_id)
        made = work(batch, read_version(spark, folder, version)).withColumn("version", F.lit(version).cast("bigint"))
        made.write.mode("overwrite").parquet(f"{out}/{VERSION}={batch_id}")

    return foreach_batch(events, run, checkpoint, "append", trigger or LIVE_ANOMALIES)
