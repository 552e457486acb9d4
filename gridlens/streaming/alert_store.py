"""A table of alerts that grows for ever, updated by micro-batches that rewrite only the days they touch.

Each day is a folder with two slots, and every row of a slot carries the batch that wrote it. A micro-batch takes the rows of
the touched days as they were before it, merges its own, and puts the result into each day's other slot; so a batch writes as
much as its days hold, however long the history is, and superseded versions do not pile up. A replayed batch ignores what it
wrote itself and finds the same rows again. (Hours as folders make thousands of tiny files where alerts are few.)
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridlens.operators.alerts import merge_alerts

DAY, SLOT, BATCH = "dia", "ranura", "batch_id"


def day_of(moment: Column) -> Column:
    """Folder of a moment; spelt so that it stays text when it is read back."""
    return F.date_format(moment, "'d'yyyyMMdd")


def _read(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.parquet(folder)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _newest(rows: DataFrame) -> DataFrame:
    """day, slot and batch of each day's newest version; reads one column of the files."""
    versions = rows.groupBy(DAY, SLOT).agg(F.max(BATCH).alias(BATCH))
    return versions.groupBy(DAY).agg(F.max_by(SLOT, BATCH).alias(SLOT), F.max(BATCH).alias("_batch"))


def merge_batch(batch: DataFrame, folder: str, batch_id: int) -> None:
    """Merge the alerts of a micro-batch into the store."""
    spark = batch.sparkSession
    rows = batch.withColumn(DAY, day_of(F.col("window_start"))).persist()
    try:
        touched = rows.select(DAY).distinct()
        stored = _read(spark, folder)
        if stored is None:
            merged, slots = rows, touched.withColumn("_slot", F.lit(None).cast("int"))
        else:
            # The join on the folder's day prunes all other folders before they are read.
            before = stored.filter(F.col(BATCH) < batch_id).join(F.broadcast(touched), DAY, "left_semi")
            newest = _newest(before)
            current = before.join(F.broadcast(newest), [DAY, SLOT]).select(*rows.columns)
            merged = merge_alerts(current, rows)
            slots = newest.select(DAY, F.col(SLOT).alias("_slot"))
        target = F.when(F.col("_slot") == 0, 1).otherwise(0)
        placed = merged.join(F.broadcast(slots), DAY, "left").withColumn(SLOT, target).drop("_slot")
        (
            placed.withColumn(BATCH, F.lit(batch_id).cast("bigint")).hint("rebalance", DAY)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, SLOT).parquet(folder)
        )
    finally:
        rows.unpersist()


def read_alerts(spark: SparkSession, folder: str, since: str | None = None) -> DataFrame:
    """All alerts in their latest state; ``since`` (a time) reads only those from its hour on, and no earlier day's files."""
    stored = spark.read.parquet(folder)
    if since is not None:
        moment = F.lit(since).cast("timestamp")
        stored = stored.filter((F.col(DAY) >= day_of(moment)) & (F.col("window_start") >= F.date_trunc("hour", moment)))
    return stored.join(F.broadcast(_newest(stored).drop("_batch")), [DAY, SLOT]).drop(DAY, SLOT, BATCH)
